from emporium.functions.macros import (  # noqa: F401
    cents_to_dollars,
    date_spine,
    seconds_between,
    surrogate_key,
)
