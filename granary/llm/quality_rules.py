"""Quality rules: counts of a text's faults and a hashed n-gram likelihood ratio.

Two multinomials over hashed n-gram buckets are counted over whole texts: one
over every document (raw corpus), one over the trusted documents. A document's
verdict is its mean log ratio per n-gram against a fixed threshold, so the same
text gets the same verdict in every run; nothing is drawn at random.

All of it is DataFrame functions. The bucket weights are one row of a bounded
array (``buckets`` doubles), fetched by a scalar subquery.

Defined cases: a null text counts as empty; a text without words has zero
counts and fails; repeated rows are judged alike, one result each; an empty
table gives no rows; without trusted documents every weight is 0 and the fixed
rules decide alone. Columns other than id and text may carry any name: they
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import SPACE, SPACE_CLASS, text_of, words_of

#: Runs of letters and digits, and runs of other visible characters.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def _token_hashes(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return F.transform(found, lambda t: F.xxhash64(t))


def bucket_weights(docs: DataFrame, trusted: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """One row with an array of log(p_trusted / p_raw), a place per bucket.

    trusted holds doc_id and is broadcast: its size is bounded by the caller.
    Counts are summed on the map side, so at most ``buckets`` rows a task move. A
    text without tokens counts as one pair of nothing with nothing.
    """
    flagged = docs.select("doc_id", _token_hashes(text_of()).alias("t")).join(
        F.broadcast(trusted.select(F.col("doc_id"), F.lit(1).alias("good")).distinct()), "doc_id", "left"
    )
    # The outer form keeps Spark from extracting the tokens once more for a filter on their number.
    each = F.posexplode_outer("t").alias("i", "h")
    grams = flagged.select(F.coalesce("good", F.lit(0)).alias("good"), "t", each).select(
        "good",
        F.explode(F.array(F.col("h"), F.xxhash64("h", F.get("t", F.col("i") + 1)))).alias("g"),
    )
    counts = grams.groupBy(F.pmod("g", F.lit(buckets)).cast("int").alias("b")).agg(
        F.count("*").alias("raw"), F.sum("good").alias("good")
    )
    places = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    full = places.join(counts, "b", "left").na.fill(0, ["raw", "good"])
    row = full.agg(
        F.sort_array(F.collect_list(F.struct("b", "raw", "good"))).alias("c"),
        F.sum("raw").alias("raw"),
        F.sum("good").alias("good"),
    )
    share = lambda n, total: F.log((n + smoothing) / (total + smoothing * buckets))
    weigh = F.transform("c", lambda x: share(x["good"], F.col("good")) - share(x["raw"], F.col("raw")))
    return row.select(F.when(F.col("good") > 0, weigh).otherwise(F.transform("c", lambda x: F.lit(0.0))).alias("w"))


def count_faults(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words to docs (which has _text).

    A repeated three-word window is found within the row: each window's hash is
    packed with its position into one long, the longs are sorted, and equal
    neighbours are compared word by word. That costs n log n for n words and
    needs no shuffle.
    """
    text = F.col("_text")
    out = docs.withColumn("_words", words_of(text))
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    out = out.withColumn("word_chars", F.char_length(F.regexp_replace(text, SPACE_CLASS + "+", "")).cast("long"))
    out = out.withColumn("n_symbols", F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"))
    out = out.withColumn(
        "_lines", F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    ).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    out = out.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    out = out.withColumn("_bits", F.char_length(F.bin(F.col("n_words"))).cast("int"))
    packed = F.expr(
        "transform(sequence(0, size(_h) - 3),"
        " i -> shiftleft(xxhash64(_h[i], _h[i + 1], _h[i + 2]), _bits) | cast(i as bigint))"
    )
    out = out.withColumn(
        "_s", F.when(F.size("_h") >= 3, F.sort_array(packed)).otherwise(F.array().cast("array<bigint>"))
    )
    place = "cast({} & (shiftleft(1L, _bits) - 1) as int)"
    same = (
        "(shiftrightunsigned(x ^ _s[{k}], _bits) = 0 and"
        f" slice(_words, {place.format('x')} + 1, 3) = slice(_words, {place.format('_s[{k}]')} + 1, 3))"
    )
    near = f"((j > 0 and {same.format(k='j - 1')}) or (j < size(_s) - 1 and {same.format(k='j + 1')}))"
    out = out.withColumn("_p", F.expr(f"sort_array(transform(filter(_s, (x, j) -> {near}), x -> {place.format('x')}))"))
    covered = F.expr(
        "3 + aggregate(sequence(1, size(_p)), 0, (n, k) -> n + if(k < size(_p), least(3, _p[k] - _p[k - 1]), 0))"
    )
    return out.withColumn("n_repeat_words", F.when(F.size("_p") > 0, covered).otherwise(0).cast("long"))


def judge_quality(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = 50,
    repeat_percent: int = 50,
    buckets: int = 16384,
    smoothing: float = 1.0,
    threshold: float = -0.5,
    keep_columns: bool = False,
) -> DataFrame:
    """One row for each row of docs: the fault counts, llr, base_failed, kept.

    llr is the mean log ratio of the text's one- and two-token n-grams (0 for a
    text without any); kept is false under ``threshold`` and for base_failed.
    With keep_columns the columns of docs stay, in a struct named ``row``.
    """
    weights = bucket_weights(
        docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")), trusted, buckets, smoothing
    ).scalar()
    kept = [F.struct("*").alias("row")] if keep_columns else []
    base = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"), *kept)
    out = count_faults(base).withColumn("_t", _token_hashes(F.col("_text"))).withColumn("_w", weights)
    total = F.expr(
        "aggregate(sequence(0, size(_t) - 1), 0D, (s, i) -> s"
        f" + _w[cast(pmod(_t[i], {buckets}) as int)]"
        f" + _w[cast(pmod(xxhash64(_t[i], get(_t, i + 1)), {buckets}) as int)])"
    )
    out = out.withColumn("llr", F.when(F.size("_t") > 0, total / (2 * F.size("_t"))).otherwise(0.0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    verdict = F.struct(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("llr") >= threshold)).alias("kept"), "llr",
        *(["row"] if keep_columns else []),
    )
    # A generated row: a filter on the verdict is not pushed below and made one expression with all that it rests on.
    return out.select(F.inline(F.array(verdict)))


def trusted_documents(labels: DataFrame, limit: int = 50_000) -> DataFrame:
    """doc_ids labelled good and not toxic, at most ``limit`` of them, chosen by a hash of the id."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
