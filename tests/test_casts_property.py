"""Property test: Spark lenient casts == a plain-Python model of their rules."""

import math
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from contrail.functions import casts

ALPHABET = "0123456789+-.eE txdnN\t"


def model(x):
    if x is None:
        return (None, None, None, None, None)
    num = re.fullmatch(casts.NUMBER_RE, x) is not None
    integer = re.fullmatch(casts.INTEGER_RE, x) is not None
    f64 = float(x.strip()) if num else None
    v = int(x.strip()) if integer else None
    i32 = v if v is not None and casts.INT32_MIN <= v <= casts.INT32_MAX else None
    u32z = v if v is not None and 0 <= v <= casts.UINT32_MAX else 0
    u8z = v if v is not None and 0 <= v <= casts.UINT8_MAX else 0
    w = x.strip(" ").lower()
    b = True if w in casts.TRUE_WORDS else False if w in casts.FALSE_WORDS else None
    return (f64, i32, u32z, u8z, b)


texts = st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=24),
                  st.sampled_from(["true", " FALSE ", "yes", "n", "0" * 22 + "7", "-0", "1e400"]))


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=50, max_size=200))
def test_casts_match_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    x = F.col("x")
    rows = df.select("i", casts.f64_or_null(x), casts.i32_or_null(x), casts.u32_or_zero(x),
                     casts.u8_or_zero(x), casts.to_bool(x)).collect()
    for r in rows:
        got, want = tuple(r)[1:], model(values[r[0]])
        for g, w in zip(got, want):
            if isinstance(w, float) and math.isinf(w):
                assert g is not None and math.isinf(g)
            else:
                assert g == w, (values[r[0]], got, want)
