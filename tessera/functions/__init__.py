"""Column expressions built from pyspark.sql.functions (JVM-side, codegen'd)."""

from tessera.functions.scalar import (  # noqa: F401
    as_category,
    ceil_of,
    code_map,
    hash_u32,
    make_id,
    no_negative_zero,
    rate_from_median,
    round_half,
    scaled,
    threshold_class,
)
