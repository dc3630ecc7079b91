"""Column expressions: built-in, JVM-side functions. Higher-order ones
(``exists``, ``filter``, ``transform``) are interpreted, the rest is compiled."""

from dxcohort.functions.arrays import code_prefixes, dx_at, dx_slice
from dxcohort.functions.expressions import (
    AGE_BANDS,
    DUAL_DOMAIN,
    RACE_DOMAIN,
    SEX_DOMAIN,
    age_band,
    bounded_broadcast,
    int_round_half_even,
    with_strata,
    zero_pad,
)

__all__ = [
    "AGE_BANDS",
    "DUAL_DOMAIN",
    "RACE_DOMAIN",
    "SEX_DOMAIN",
    "age_band",
    "bounded_broadcast",
    "code_prefixes",
    "dx_at",
    "dx_slice",
    "int_round_half_even",
    "with_strata",
    "zero_pad",
]
