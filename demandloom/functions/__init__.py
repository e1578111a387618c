from demandloom.functions.exprs import (  # noqa: F401
    all_of,
    cut,
    numeric_columns,
    ratio,
    scalar_struct,
    series_window,
    slug,
    z_value,
)
