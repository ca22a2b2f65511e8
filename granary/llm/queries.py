"""The corpus queries that ``__spark_entry__`` registers, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import table
from granary.llm.decontamination import find_leaks
from granary.llm.hard_negatives import mine_hard_negatives
from granary.llm.html_text import extract_text
from granary.llm.jaccard_join import near_duplicates
from granary.llm.language_model import score_documents
from granary.llm.license_scan import PHRASES, scan_licenses
from granary.llm.packing import pack
from granary.llm.pii import scan_pii
from granary.llm.quality_rules import judge_quality, trusted_documents
from granary.llm.quality_ranker import rank_quality
from granary.llm.secret_scan import scan_secrets
from granary.llm.sentence_pieces import encode_pieces, piece_digests
from granary.llm.vector_codes import compress_vectors


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = trusted_documents(table(spark, sf_dir, "labels"))
    return judge_quality(table(spark, sf_dir, "documents"), trusted)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pii(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 50; where an id is divisible by 7, its label is first moved on by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(encode_pieces(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_packing,
        op2_license_scan,
        op3_secret_scan,
        op4_quality_rules,
        op5_lm_scoring,
        op6_benchmark_decontamination,
        op7_html_extraction,
        op8_ngram_jaccard_join,
        op9_pii,
        op10_quality_classifier,
        op11_vector_codes,
        op12_hard_negatives,
        op13_sentence_pieces,
    ]
    return {f.__name__: f for f in found} | BASE_QUERIES


#: Shingle sets joined with each other, links, and all that each document reaches.
NEAR_DUPLICATES_SQL = r"""
    WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(len(w) - 4), lambda i: w[i + 1 : i + 5]) WHEN len(w) > 0 THEN [w] ELSE [] END)) AS g FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
    r AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.root = l.a)
    SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.root) AS component_id FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""


def _base_of(operator: Callable[[SparkSession, str], DataFrame], *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(spark, sf_dir).select(*columns)


def base_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = F.round("base_score", 3).alias("base_score")
    return op5_lm_scoring(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", rounded)


#: The columns that the contracts fix, of five operators whose other columns SQL can't express.
BASE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "base_licenses": _base_of(op2_license_scan, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"),
    "base_secrets": _base_of(op3_secret_scan, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256"),
    "base_faults": _base_of(op4_quality_rules, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
    "base_unigrams": base_unigrams,
    "base_personal_data": _base_of(op9_pii, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"),
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _spans_sql(kinds: list[tuple[str, str, str]]) -> str:
    """doc_id, a count for each kind, and the hash of all spans; kinds are (name, pattern, test of a match m)."""
    found = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS k, '{name}' AS kind, m, s FROM (SELECT doc_id, unnest(m) AS m,
        unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(p[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))) AS s
        FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS p FROM d)) WHERE {test}"""
        for k, (name, pattern, test) in enumerate(kinds)
    )
    counts = ", ".join(f"coalesce(count(*) FILTER (kind = '{name}'), 0) AS n_{name}" for name, _, _ in kinds)
    names = ", ".join(f"coalesce(n_{name}, 0) AS n_{name}" for name, _, _ in kinds)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
    g AS (SELECT doc_id, {counts}, string_agg(kind || ':' || s::BIGINT || ':' || (s + length(m))::BIGINT, ',' ORDER BY s, k) AS spans FROM f GROUP BY 1)
    SELECT d.doc_id, {names}, sha256(coalesce(spans, '')) AS base_sha256 FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = rf"""(?:{_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SECRETS = [
    ("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 1)) >= 6"),
    ("access", "AKIA[A-Z0-9]{16,}", "true"),
    ("hex", "[0-9a-f]{24,}", "true"),
]
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN (length({_DIGITS}) - i) % 2 = 0
    THEN substr({_DIGITS}, i, 1)::INT ELSE substr({_DIGITS}, i, 1)::INT * 2 - CASE WHEN substr({_DIGITS}, i, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(right(x, 3) AS INT), 0) > 255)) = 0"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
]

_PHRASES = " UNION ALL ".join(f"SELECT {p.split()!r} AS p, '{label}' AS label" for p, label in PHRASES.items())
_LICENSES = rf"""WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    h AS (SELECT doc_id, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1] = p[1] AND w[i + 1 : i + len(p)] = p)) AS i FROM w, ({_PHRASES})),
    g AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h GROUP BY 1)
    SELECT w.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels
    FROM w LEFT JOIN g ON w.doc_id = g.doc_id"""

_FAULTS = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
    g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
    r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE c > 1) GROUP BY 1)
    SELECT l.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed FROM l LEFT JOIN r ON l.doc_id = r.doc_id"""

#: The checksum of an id's digits, bit by bit; the constants are those of the common 32-bit polynomial.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)),
    4294967295::BIGINT)"""
_UNIGRAMS = rf"""WITH d AS (SELECT doc_id, {_CRC} % 7 = 2 AS held_out, list_append(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), '') AS w FROM documents),
    t AS (SELECT doc_id, held_out, unnest(w) AS w FROM d), c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY 1),
    n AS (SELECT sum(c) AS n, count(*) AS v FROM c)
    SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n)::BIGINT AS train_tokens,
    round(sum(log10((coalesce(c, 0) + 1) / (n + v + 1))), 3) AS base_score FROM t LEFT JOIN c USING (w), n GROUP BY doc_id"""

BASE_SQL = {
    "base_licenses": _LICENSES,
    "base_secrets": _spans_sql(_SECRETS),
    "base_faults": _FAULTS,
    "base_unigrams": _UNIGRAMS,
    "base_personal_data": _spans_sql(_PERSONAL),
}


def _codes_sql(rounds: int = 6) -> str:
    """Parts as rows, and a pair of steps for each round: the nearest entry of each part, then the entries' means."""
    nearest = """SELECT x.vec_id, x.part, arg_min(e.entry, (list_sum(list_transform(range(1, 9), lambda i: (x.x[i] - e.x[i]) * (x.x[i] - e.x[i]))), e.entry)) AS entry,
        min(list_sum(list_transform(range(1, 9), lambda i: (x.x[i] - e.x[i]) * (x.x[i] - e.x[i]))))::BIGINT AS error
        FROM x JOIN b{k} e ON x.part = e.part GROUP BY 1, 2"""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED ({nearest.format(k=k)})")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT part, entry, list(floor(s / n)::BIGINT ORDER BY c) AS x FROM (SELECT x.part, a.entry, c, sum(x.x[c]) AS s, count(*) AS n
            FROM x JOIN a{k} a ON x.vec_id = a.vec_id AND x.part = a.part, range(1, 9) r(c) GROUP BY 1, 2, 3) GROUP BY 1, 2),
            b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m ON b.part = m.part AND b.entry = m.entry)""")
    return f"""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        x AS MATERIALIZED (SELECT vec_id, part, v[8 * part + 1 : 8 * part + 8] AS x FROM e, range(8) p(part)),
        f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e ORDER BY vec_id LIMIT 16),
        b0 AS (SELECT part, entry, x FROM x JOIN f USING (vec_id)), {", ".join(steps)},
        c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error FROM a{rounds} GROUP BY 1)
        SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
        (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256 FROM c JOIN e USING (vec_id)"""


#: All scores of the anchors, their positives by rank, and the first rows of each window.
HARD_NEGATIVES_SQL = """WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.id AS a, b.id AS b, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS s
        FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 50 = 0),
    p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
    SELECT p.a AS anchor_id, p.b AS positive_id, row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b)::INT AS rank,
        n.b AS negative_id, p.s AS positive_score, n.s AS negative_score
    FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
    QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) <= 3"""


def oracle_sql() -> dict[str, str]:
    return {"op8_ngram_jaccard_join": NEAR_DUPLICATES_SQL, "op11_vector_codes": _codes_sql(), "op12_hard_negatives": HARD_NEGATIVES_SQL} | BASE_SQL
