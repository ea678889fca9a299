"""Traps T4 and T14 and the unique key of dim_customers, on the invented shop of test_seed_goldens with rows added."""

import pytest

import test_seed_goldens as G

L2_USERS = [(5, "z@x", "Zed", "Gold", "2024-01-05 00:00:00", "2024-01-05 00:00:00", "false"),
            (5, "e@x", "Eve", "Bronze", "2024-01-05 00:00:00", "2024-01-05 00:00:00", "false")]


@pytest.fixture(scope="module")
def traps(spark, tmp_path_factory):
    """Second batch: user 5 twice with one load time. Orders 12 and 13 are of users without a session."""
    from emporium.sources.schemas import RAW_SCHEMAS, SOURCE_OF

    root = tmp_path_factory.mktemp("traps")
    for table, batches in G.ROWS.items():
        folder = root / SOURCE_OF[table]
        folder.mkdir(exist_ok=True)
        for name, rows, load in zip(("initial", "incremental"), batches, (G.L1, G.L2)):
            rows = rows + (L2_USERS if (table, name) == ("users", "incremental") else [])
            lines = [",".join(RAW_SCHEMAS[table].names)] + [",".join(map(str, (*r, load))) for r in rows]
            (folder / f"{table}_{name}.csv").write_text("\n".join(lines) + "\n")
    return G.shop(spark, str(root), ("initial", "incremental"))


def test_a_user_twice_in_a_batch(traps):
    assert [(r.email, r.name, r.tier) for r in traps.raw["users"].where("user_id = 5").collect()] == [("e@x", "Eve", "Bronze")]


def test_customers_are_unique_after_two_batches(traps):
    assert sorted(r.user_id for r in traps.dim_customers.collect()) == [1, 2, 4, 5]


def test_orders_without_a_session_stay_unattributed(traps):
    got = {r.order_id: r.attribution_session_id for r in traps.fct_attribution.collect()}
    assert got == {10: "S1", 11: "S1", 12: None, 13: None}
