"""The field comparison over all orders, the ratio rule by brute force."""

from collections import Counter
from difflib import SequenceMatcher

from quillframe import plans


def test_every_order_is_compared(spark, sf):
    got = {(r.field, r.basis, r.is_match): r.n for r in plans.queries()["field_compare_all"](spark, sf).collect()}
    keys = [r.o_orderkey for r in spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey").collect()]
    assert sum(got.values()) == len(keys)
    near = SequenceMatcher(None, "clerkandmercer", "and").ratio() >= 0.90
    want = Counter(("Agent Occupation", "ratio", near) for k in keys if k % 10 == 5)
    assert {k: n for k, n in got.items() if k[1] == "ratio"} == want and want
