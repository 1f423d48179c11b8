"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from contrail.functions.casts import (
    f64_or_null, i32_or_null, u32_or_null, u32_or_zero, u8_or_zero, to_bool, round_ch, exact_avg,
    strict_double, strict_int, strict_bool,
)
from contrail.functions.time import (
    EPOCH_NTZ, ntz_literal, seconds_to_ntz, micros_to_ntz, ntz_to_seconds, instant_to_ntz,
    ntz_to_instant, start_of_hour,
)

__all__ = [
    "f64_or_null", "i32_or_null", "u32_or_null", "u32_or_zero", "u8_or_zero", "to_bool",
    "round_ch", "exact_avg", "strict_double", "strict_int", "strict_bool", "EPOCH_NTZ", "ntz_literal",
    "seconds_to_ntz", "micros_to_ntz", "ntz_to_seconds", "instant_to_ntz",
    "ntz_to_instant", "start_of_hour",
]
