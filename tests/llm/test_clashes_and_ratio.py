import math

import pytest
from pyspark.sql import functions as F

from granary.llm.jaccard_join import near_duplicates
from granary.llm.language_model import score_documents
from granary.llm.license_scan import scan_licenses
from granary.llm.pii import scan_pii
from granary.llm.quality_rules import _token_hashes, judge_quality
from granary.llm.secret_scan import scan_secrets

#: Names that operators use for columns of their own.
NAMES = "_text text_hash words pos h row copy trainer n key doc kind start end span spans score labels size again places w g u v m".split()
OPERATORS = {
    "op2": scan_licenses, "op3": scan_secrets, "op5": lambda docs: score_documents(docs, trainer_tokens=500), "op8": near_duplicates, "op9": scan_pii,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_of_clashing_names_change_nothing(make, prose, name):
    own = prose(12, 21, 40)
    texts = [*enumerate(own), (50, own[0]), (51, own[1] + " token=abcdefgh12 mit license a@b.co"), (52, None), (53, "")]
    docs = make(texts)
    taken = {c.lower() for c in docs.columns}
    extra = docs.withColumns({c: F.lit(k) for k, c in enumerate(NAMES) if c not in taken})
    plain, clashing = (sorted(map(tuple, OPERATORS[name](d).collect()), key=repr) for d in (docs, extra))
    assert plain == clashing and len(plain) == len(texts)


def test_likelihood_ratio_by_brute_force(make, prose, spark):
    """Every token and every pair of neighbours, the last with nothing, in hashed buckets of two smoothed counts."""
    buckets, smoothing = 64, 0.5
    texts = [*enumerate(prose(8, 22, 30)), (20, "a b a b a"), (21, None), (22, "one")]
    docs, trusted = make(texts), spark.createDataFrame([(k,) for k in (0, 1, 20)], "doc_id long")
    hashes = docs.select("doc_id", _token_hashes(F.coalesce("text", F.lit(""))).alias("t"))
    pairs = F.transform("t", lambda h, i: F.array(h, F.xxhash64(h, F.get(F.col("t"), i + 1))))
    grams = {r.doc_id: [g % buckets for g in r.g] for r in hashes.select("doc_id", F.flatten(pairs).alias("g")).collect()}
    nothing = spark.range(1).select(F.xxhash64(F.lit(None).cast("long"), F.lit(None).cast("long"))).first()[0] % buckets
    count = lambda ids: [sum(g == b for k in ids for g in grams[k] or [nothing]) for b in range(buckets)]
    raw, good = count(grams), count([0, 1, 20])
    weight = [math.log((good[b] + smoothing) / (sum(good) + smoothing * buckets)) - math.log((raw[b] + smoothing) / (sum(raw) + smoothing * buckets)) for b in range(buckets)]
    for r in judge_quality(docs, trusted, buckets=buckets, smoothing=smoothing).collect():
        own = grams[r.doc_id]
        assert r.llr == pytest.approx(sum(weight[g] for g in own) / len(own) if own else 0.0)
