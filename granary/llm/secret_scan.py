"""Secret scans: fixed patterns, and strings whose sliding-window entropy is high.

Matches are marked in the text, and the text is split at the marks; running sums
of the pieces' lengths give code point offsets. Candidate strings are scored by
Shannon entropy over a sliding window of characters, for each character class
with its own window and bound. The sum of c * log2(c) over a window's character
counts is kept incrementally: a character that enters with count c adds
f(c) - f(c - 1), one that leaves with count c adds f(c - 1) - f(c), and the
entropy is log2(window) - sum / window. Counts and running sums are Spark window
functions over one candidate's characters, so the cost is linear in its length.

All of it is DataFrame functions. Only texts with a match or a candidate are
shuffled, by their pieces.

Defined cases: a null text counts as empty; a text without matches has counts
of 0, an empty list of spans and the hash of the empty string; the two marking
characters (U+0001, U+0002) are read as U+0003 where a text holds them, which no
pattern matches; repeated rows get the same result each; an empty table gives
no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import materialize, text_of

#: The kinds in the order of the contract. A run of access or hex characters is one match and no shorter
#: part of it counts, so the least length can stand in the pattern; an assignment's value is measured afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
KINDS = ("assign", "access", "hex", "entropy")
#: Candidates of the entropy scan: long runs of the characters that encoded keys use.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"


@dataclass(frozen=True)
class EntropyClass:
    """Candidates whose characters all match ``characters``: window length and least entropy in bits."""

    name: str
    characters: str
    window: int
    bits: float


#: The first class that fits a candidate counts.
CLASSES = (
    EntropyClass("hex", "[0-9a-fA-F]+", 20, 3.0),
    EntropyClass("alphanumeric", "[A-Za-z0-9]+", 20, 3.5),
    EntropyClass("base64", "[A-Za-z0-9+/_=-]+", 20, 3.7),
)
#: Candidates that are no secrets: words and paths without digits, numbers, UUIDs, repeated characters, examples (by what
#: stands after the last = or /: a name or folder before a secret does not excuse it). Each is matched by itself.
ALLOW = (
    r"[^0-9]*",
    r"[0-9_=+/-]*",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"(.)\1*",
    r"(?i).*(example|sample|placeholder|xxxx|0000000|1234567|abcdef)[^=/]*=*",
    r"[A-Za-z]+[0-9]{1,4}",
)


def _pieces(text: Column, pattern: str) -> Column:
    marked = F.regexp_replace(text, pattern, "\x01$0\x02")
    return F.split(marked, "[\x01\x02]", -1)


def marked_matches(docs: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(row, doc_id, text_hash, kind, start, end, match) for every leftmost match of each pattern in _text."""
    text = F.translate("_text", "\x01\x02", "\x03\x03")
    kinds = [F.struct(F.lit(k).alias("kind"), _pieces(text, p).alias("pieces")) for k, p in patterns.items()]
    each = (
        docs.withColumn("row", F.monotonically_increasing_id())  # before the rows are multiplied
        .select("row", "doc_id", F.xxhash64("_text").alias("text_hash"), F.explode(F.array(*kinds)).alias("k"))
        .filter(F.size("k.pieces") > 1)
        .select("row", "doc_id", "text_hash", "k.kind", F.posexplode_outer("k.pieces").alias("i", "piece"))
    )
    inside = F.col("i") % 2 == 1
    short = each.select(
        "row", "doc_id", "text_hash", "kind", "i", F.char_length("piece").cast("long").alias("n"),
        F.when(inside, F.col("piece")).alias("match"),
    )
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return (
        short.withColumn("end", F.sum("n").over(so_far))
        .filter(F.col("match").isNotNull())
        .withColumn("start", F.col("end") - F.col("n"))
    )


def window_entropies(candidates: DataFrame, classes: tuple[EntropyClass, ...]) -> DataFrame:
    """Adds entropy, the largest over a candidate's windows, to (row, start, match, ...); short ones drop out.

    Events are a character's entry, at its place, and its departure, a window
    later; a place's sum holds all events up to it.
    """
    fits = None
    for c in classes:
        found = F.struct(F.lit(c.name).alias("name"), F.lit(c.window).alias("window"), F.lit(c.bits).alias("bits"))
        here = F.col("match").rlike(f"^(?:{c.characters})$")
        fits = F.when(here, found) if fits is None else fits.when(here, found)
    known = candidates.withColumn("class", fits).filter(F.char_length("match") >= F.col("class.window"))
    letters = known.select(
        "row", "start", F.col("class.window").alias("w"), F.posexplode(F.split("match", "")).alias("p", "ch")
    ).filter(F.col("ch") != "")
    same = Window.partitionBy("row", "start", "ch", "w").orderBy("p")
    # Windows have one length for a class, and a candidate has one class.
    out = None
    for width in sorted({c.window for c in classes}):
        part = letters.filter(F.col("w") == width)
        before = same.rangeBetween(-(width - 1), 0)
        after = same.rangeBetween(0, width - 1)
        part = part.withColumn("enters", F.count("*").over(before)).withColumn("leaves", F.count("*").over(after))
        out = part if out is None else out.unionByName(part)
    f = lambda c: F.when(c > 0, c * F.log2(c)).otherwise(0.0)
    events = out.select(
        "row", "start", "w",
        F.explode(F.array(
            F.struct(F.col("p").alias("at"), (f(F.col("enters")) - f(F.col("enters") - 1)).alias("d")),
            F.struct((F.col("p") + F.col("w")).alias("at"), (f(F.col("leaves") - 1) - f(F.col("leaves"))).alias("d")),
        )).alias("e"),
    ).select("row", "start", "w", "e.at", "e.d")
    by_place = events.groupBy("row", "start", "w", "at").agg(F.sum("d").alias("d"))
    running = Window.partitionBy("row", "start", "w").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sums = by_place.withColumn("s", F.sum("d").over(running))
    last = known.select(
        "row", "start", "end", "doc_id", "text_hash", "class", "match", (F.char_length("match") - 1).alias("last")
    )
    best = (
        sums.filter(F.col("at") >= F.col("w") - 1)
        .join(last, ["row", "start"])
        .filter(F.col("at") <= F.col("last"))
        .groupBy("row", "start", "end", "doc_id", "text_hash", "class", "match")
        .agg(F.max(F.log2(F.col("w").cast("double")) - F.col("s") / F.col("w")).alias("entropy"))
    )
    return best


def scan_secrets(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    classes: tuple[EntropyClass, ...] = CLASSES,
    allow: tuple[str, ...] = ALLOW,
) -> DataFrame:
    """One row for each row of docs: n_assign, n_access, n_hex, base_sha256, spans.

    spans lists kind:start:end of all spans; an entropy span is left out where a
    pattern's span already covers part of it.
    """
    base = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"))
    found = marked_matches(base, PATTERNS | {"entropy": CANDIDATE})
    good = (
        F.when(F.col("kind") == "assign", F.char_length(F.regexp_extract("match", ASSIGN, 2)) >= 6)
        .when(F.col("kind") == "entropy", ~functools.reduce(Column.__or__, [F.col("match").rlike(f"^(?:{a})$") for a in allow], F.lit(False)))
        .otherwise(True)
    )
    # Few rows; written once, as the pattern and entropy branches both read them.
    kept = materialize(found.filter(good), "secrets")
    columns = ["row", "doc_id", "text_hash", "kind", "start", "end"]
    entropy = (
        window_entropies(kept.filter(F.col("kind") == "entropy"), classes)
        .filter(F.col("entropy") >= F.col("class.bits"))
        .select("row", "doc_id", "text_hash", F.lit("entropy").alias("kind"), "start", "end")
    )
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = kept.filter(F.col("kind") != "entropy").select(*columns).unionByName(entropy)
    # A base span touches another that starts at or after its own start if it ends later, one that starts before if it starts
    # before that one's end; the last end and the first start on each side tell.
    base_span = F.col("kind") != "entropy"
    rising, falling = (Window.partitionBy("row").orderBy(o).rangeBetween(Window.unboundedPreceding, 0) for o in (F.asc("start"), F.desc("start")))
    left, right = F.max(F.when(base_span, F.col("end"))).over(rising), F.min(F.when(base_span, F.col("start"))).over(falling)
    touched = F.coalesce(left > F.col("start"), F.lit(False)) | F.coalesce(right < F.col("end"), F.lit(False))
    alone = spans.withColumn("touched", touched).filter(base_span | ~F.col("touched"))
    each = alone.groupBy("row", "doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("s")
    )
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    out = each.withColumn("b", F.filter("s", lambda x: x["kind"] != "entropy"))
    count = lambda k: F.size(F.filter("b", lambda x: x["kind"] == k)).cast("long")
    # Repeated rows hold the same spans; one of each goes on.
    rows = out.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.max(count("assign")).alias("n_assign"),
        F.max(count("access")).alias("n_access"),
        F.max(count("hex")).alias("n_hex"),
        F.max(F.array_join(F.transform("b", line), ",")).alias("base"),
        F.max(F.array_join(F.transform("s", line), ",")).alias("spans"),
    )
    every = base.select("doc_id", F.xxhash64("_text").alias("_text_hash"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return every.join(rows, every.doc_id.eqNullSafe(rows._id) & (every._text_hash == rows._hash), "left").select(
        "doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
