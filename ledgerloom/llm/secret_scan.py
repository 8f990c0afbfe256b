"""Secrets in texts: three fixed patterns, and strings that a battery of randomness tests takes for keys.

Fixed patterns give the kinds assign, access and hex. Any other unbroken string of ``LEAST_CHARS`` characters
is a candidate of kind random. Its encoding is inferred from its characters, and three tests are made against
"symbols are drawn uniformly and independently": chi-squared over the alphabet (one-sided: ordinary strings
repeat symbols), runs of symbols in the upper or lower half, and serial correlation of neighbours (both
two-sided). Three times the smallest p-value is the string's own (Bonferroni). A small one says: ordinary.

A run that mixes signs of two encodings, or is too short for its own, is cut at ``/``, ``+``, ``-`` and ``_``,
and every piece of ``LEAST_CHARS`` letters and digits is a candidate of its own.

False discoveries are held down in two ways that look at length. Rejections are made by Benjamini-Hochberg at
``RATE`` within each band of lengths, so at most that share of the strings thrown away are keys. And a string
too short for the tests to tell it from prose is no candidate: ``LEAST`` sets the length per encoding. The
p-values enter a grid of counts (bands x bins, bounded), so nothing is sorted or collected.

All of it is DataFrame functions: matches come from regexp_extract_all, their places from the lengths of the
pieces between them (split), counted in code points.

Defined results: null texts are empty; without a match a document has zero counts, the hash of the empty
string and an empty span list; repeated rows are reported each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored, whole_text

# The patterns of the base kinds, and the kinds in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a run is one match, so the least length can stand in the pattern
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

LEAST_CHARS = 24
PIECE = rf"[A-Za-z0-9]{{{LEAST_CHARS},}}"  # between the signs of a run that has no encoding
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST_CHARS},}}={{0,2}}"
LOWER, CAPITAL, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Encoding, pattern of the whole string, alphabet, least length; the first that fits is taken.
ENCODINGS = (
    ("decimal", r"^[0-9]+$", DIGITS, 48),
    ("hex", r"^[0-9a-f]+$", DIGITS + LOWER[:6], 24),
    ("hex_upper", r"^[0-9A-F]+$", DIGITS + CAPITAL[:6], 24),
    ("lower", r"^[a-z]+$", LOWER, 64),
    ("upper", r"^[A-Z]+$", CAPITAL, 64),
    ("base32", r"^[A-Z2-7]+=*$", CAPITAL + DIGITS[2:8], 24),
    ("lower_digits", r"^[a-z0-9]+$", DIGITS + LOWER, 24),
    ("letters", r"^[A-Za-z]+$", CAPITAL + LOWER, 48),
    ("base62", r"^[A-Za-z0-9]+$", DIGITS + CAPITAL + LOWER, 24),
    ("base64", r"^[A-Za-z0-9+/]+=*$", CAPITAL + LOWER + DIGITS + "+/", 32),
    ("base64url", r"^[A-Za-z0-9_-]+=*$", CAPITAL + LOWER + DIGITS + "-_", 32),
)
RATE = 0.05
BINS_PER_E = 4  # bins of the p-value grid in one factor of e
LAST_BIN = 400


def _pieces(text: Column, pattern: str, group: int, hint: Column) -> Column:
    """Per match: length of the text before it, length of the match, and the chosen group. Null without one."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    chosen = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.arrays_zip(gaps.alias("gap"), F.transform(found, F.length).alias("size"), chosen.alias("value"))
    return F.when(hint & text.rlike(pattern), zipped)


def _matches(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row, and per kind its matches (slim, as few texts have any)."""
    text = F.col("text")
    any_text = F.lit(True)
    return docs.select("doc_id", whole_text().alias("text")).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        _pieces(text, ASSIGN, 2, any_text).alias("assign"),
        _pieces(text, ACCESS, 0, text.contains("AKIA")).alias("access"),
        _pieces(text, HEX, 0, any_text).alias("hex"),
        _pieces(text, CANDIDATE, 0, any_text).alias("random"),
    )


def _placed(found: DataFrame, kind: str) -> DataFrame:
    """row, kind, begin, stop, value of every match of one kind; failing ones still take their place."""
    each = found.where(F.col(kind).isNotNull()).select("row", F.posexplode(kind).alias("n", "m"))
    each = each.select("row", "n", "m.*")
    before = Window.partitionBy("row").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce("size", F.lit(0))  # the piece behind the last match has no match
    each = each.withColumn("stop", F.sum(F.col("gap") + size).over(before)).where("size IS NOT NULL")
    return each.select(
        "row", F.lit(KINDS.index(kind)).alias("kind"), (F.col("stop") - F.col("size")).alias("begin"), "stop", "value"
    )


def _least() -> Column:
    """The least length of a candidate's encoding; null without one."""
    least = F.lit(None)
    for _, pattern, _, shortest in reversed(ENCODINGS):
        least = F.when(F.col("value").rlike(pattern), F.lit(shortest)).otherwise(least)
    return least


def _cut(candidates: DataFrame) -> DataFrame:
    """The candidates, and instead of those that no encoding takes their pieces of sufficient length."""
    taken = F.coalesce(F.length(F.regexp_replace("value", "=+$", "")) >= _least(), F.lit(False))
    pieces = candidates.where(~taken).withColumn("m", _pieces(F.col("value"), PIECE, 0, F.lit(True))).where("m IS NOT NULL")
    each = pieces.select("row", "kind", F.col("begin").alias("at"), F.posexplode("m").alias("n", "m"))
    each = each.select("row", "kind", "at", "n", "m.*")
    before = Window.partitionBy("row", "at").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce("size", F.lit(0))
    each = each.withColumn("stop", F.col("at") + F.sum(F.col("gap") + size).over(before)).where("size IS NOT NULL")
    each = each.select("row", "kind", (F.col("stop") - F.col("size")).alias("begin"), "stop", "value")
    return candidates.where(taken).unionByName(each)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal law for z >= 0, by a published polynomial with errors below 1e-7."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / 2.5066282746310002 * poly


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z)))


def tested(candidates: DataFrame) -> DataFrame:
    """Adds encoding, n, p to rows with a string ``value``; strings without or too short for one go."""
    encoding = alphabet = least = F.lit(None)
    for name, pattern, letters, shortest in reversed(ENCODINGS):
        fits = F.col("value").rlike(pattern)
        encoding = F.when(fits, F.lit(name)).otherwise(encoding)
        alphabet = F.when(fits, F.lit(letters)).otherwise(alphabet)
        least = F.when(fits, F.lit(shortest)).otherwise(least)
    body = F.regexp_replace("value", "=+$", "")
    rows = candidates.withColumns({"encoding": encoding, "alphabet": alphabet, "least": least, "body": body})
    rows = rows.withColumns({"n": F.length("body"), "k": F.length("alphabet")}).where("n >= least")
    chars = F.split("body", "")
    rows = rows.withColumn("at", F.transform(chars, lambda c: F.instr(F.col("alphabet"), c) - 1))
    n, k, at = F.col("n").cast("double"), F.col("k").cast("double"), F.col("at")
    squares = F.aggregate(
        F.array_distinct(chars),
        F.lit(0.0),
        lambda a, c: a + F.pow(n - F.length(F.replace(F.col("body"), c, F.lit(""))), 2.0),
    )
    chi = F.greatest(squares * k / n - n, F.lit(1e-9))
    df = k - 1
    z_chi = (F.pow(chi / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    half = F.transform(at, lambda x: (x * 2 >= F.col("k")).cast("int"))
    pairs = F.sequence(F.lit(1), F.col("n") - 1)
    changes = F.aggregate(
        pairs, F.lit(0.0), lambda a, i: a + F.abs(F.element_at(half, i) - F.element_at(half, i + 1)).cast("double")
    )
    z_runs = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    middle = (k - 1) / 2
    product = F.aggregate(
        pairs, F.lit(0.0), lambda a, i: a + (F.element_at(at, i) - middle) * (F.element_at(at, i + 1) - middle)
    )
    z_serial = product / ((k * k - 1) / 12) / F.sqrt(n - 1)
    rows = rows.withColumns({"z1": z_chi, "z2": z_runs, "z3": z_serial})
    p = F.least(
        F.when(F.col("z1") > 0, _upper_tail(F.col("z1"))).otherwise(F.lit(0.5)),
        _two_sided(F.col("z2")),
        _two_sided(F.col("z3")),
    )
    rows = rows.withColumn("p", F.greatest(F.least(F.lit(1.0), 3 * p), F.lit(1e-300)))
    return rows.drop("alphabet", "least", "body", "at", "k", "z1", "z2", "z3")


def _bin(p: Column) -> Column:
    return F.least(F.floor(-F.log(p) * BINS_PER_E), F.lit(LAST_BIN)).cast("int")


def random_strings(candidates: DataFrame, rate: float = RATE) -> DataFrame:
    """The candidates that the battery does not reject, after false-discovery control per length band."""
    rows = tested(candidates).withColumns({"band": F.floor(F.log2("n") * 2).cast("int"), "bin": _bin(F.col("p"))})
    counts = rows.groupBy("band", "bin").agg(F.count("*").alias("c"))
    smaller = Window.partitionBy("band").orderBy(F.desc("bin"))  # at most LAST_BIN + 1 rows a band
    counts = counts.withColumns(
        {"below": F.sum("c").over(smaller), "m": F.sum("c").over(Window.partitionBy("band"))}
    )
    edge = F.exp(-F.col("bin") / F.lit(float(BINS_PER_E)))  # no p-value of the bin is larger
    limits = counts.where(edge * F.col("m") <= rate * F.col("below")).groupBy("band").agg(F.min("bin").alias("from_bin"))
    kept = rows.join(F.broadcast(limits), "band", "left")
    return kept.where("from_bin IS NULL OR bin < from_bin").drop("band", "bin", "from_bin")


def secret_spans(docs: DataFrame, rate: float = RATE) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, row) and (spans: row, kind number, begin, stop, value, encoding, p)."""
    found = stored(_matches(docs), "secret-matches")
    base = _placed(found, "assign").where("length(value) >= 8")
    base = base.unionByName(_placed(found, "access")).unionByName(_placed(found, "hex"))
    candidates = stored(_placed(found, "random"), "secret-candidates")
    spans = base.unionByName(random_strings(_cut(candidates), rate), allowMissingColumns=True)
    same = Window.partitionBy("row", "begin", "stop")
    spans = spans.withColumn("first_kind", F.min("kind").over(same)).where("kind < 3 OR first_kind = 3")
    return found.select("doc_id", "row"), spans.select("row", "kind", "begin", "stop", "value", "encoding", "p")


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per document: doc_id, found (array of kind, begin, stop, encoding, p; by begin, then kind)."""
    rows, spans = secret_spans(docs, rate)
    one = F.struct("begin", "kind", "stop", "encoding", "p")
    lists = spans.groupBy("row").agg(F.sort_array(F.collect_list(one)).alias("found"))
    empty = F.array().cast(lists.schema["found"].dataType)
    return rows.join(lists, "row", "left").select("doc_id", F.coalesce("found", empty).alias("found"))
