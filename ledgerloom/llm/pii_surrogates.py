"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Entities are found by patterns: e-mail addresses, phone numbers, IPv4 addresses, social security numbers,
payment cards (with a valid check digit) and names (after a title, or a known given name before a surname).
Every distinct part gets one surrogate for the whole table, from SHA-256 over a secret key, its kind and its
value, so one person stays one person everywhere (names go word by word: "Ms Lopez" follows "Ana Lopez").
Letters become letters of their case and script, digits digits; cards keep a valid check digit, addresses
valid octets, given names the ending of their gender.

Collision checks: a surrogate must differ from every original of its kind and from every other surrogate.
Of parts that meet on one surrogate the smallest value keeps it, the others are drawn again with the next
attempt number, from ``WIDEN`` on with a longer form, until none is left.

Only parts are shuffled and joined, then put back between the pieces of the texts that hold any; other texts
pass untouched. A text with a run of digits that has no valid check digit is searched once more without that
run as a card, so the phone or social security number in it is found. Defined results: null texts stay null, empty texts empty, with no entities; repeated rows are
each replaced alike; columns other than the text pass through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

# Titles with the gender they tell, and given names known without a title.
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа")
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
NEUTRAL_TITLES = ("Dr", "Prof")
FEMALE_NAMES = ("Maria", "Ana", "Anna", "Laura", "Julia", "Sophie", "Claire", "Carmen", "Emma", "Olivia", "Mary", "Susan")
MALE_NAMES = ("John", "James", "Robert", "Michael", "David", "Peter", "Hans", "Pierre", "Jean", "Carlos", "Juan", "Thomas")

_WORD = r"\p{Lu}[\p{L}'’-]*+"
_LOCAL = r"[\p{L}0-9._%+-]"
EMAIL = rf"(?<!{_LOCAL}){_LOCAL}++@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{{2,}}"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?:(?<![0-9+])\+[0-9]{1,3}[ .-]?|(?<![0-9+]))(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])(?![ -][0-9])"
_TITLES = "|".join((*FEMALE_TITLES, *MALE_TITLES, *NEUTRAL_TITLES))
NAME = rf"(?<!\p{{L}})(?:(?:{_TITLES})\.?\x20{_WORD}(?:\x20{_WORD}){{0,2}}|(?:{'|'.join((*FEMALE_NAMES, *MALE_NAMES))})\x20{_WORD})"
KINDS = (("email", EMAIL), ("ip", IP), ("ssn", SSN), ("phone", PHONE), ("card", CARD), ("name", NAME))
ANY = "|".join(pattern for _, pattern in KINDS)
# A mark stands before a run of digits that is no card, so the second search passes over it as a card only. Texts
# that hold the mark's first character have it escaped, so a mark is always told from the text.
_SIGN, _ESCAPED, _MARK = "\ue001", "\ue001\ue002", "\ue001\ue003"
AGAIN = "|".join(rf"(?<!{_MARK}){pattern}" if name == "card" else pattern for name, pattern in KINDS)

WIDEN = 4
ROUNDS = 40
CYRILLIC = ("абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ")
GREEK = ("αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
LATIN = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _digits(value: Column) -> Column:
    return F.split(F.regexp_replace(value, "[^0-9]", ""), "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of the check rule over an array of digit characters; the last digit counts once."""
    n = F.size(digits)
    return F.aggregate(
        F.transform(
            digits,
            lambda d, i: F.when((n - i) % 2 == 0, (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5)).otherwise(d.cast("int")),
        ),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )


def _kind(value: Column) -> Column:
    """Kind of a matched string; null for a run of digits without a valid check digit."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS):
        fits = value.rlike(rf"^(?:{pattern})$")
        if name == "card":
            fits = fits & (_luhn_sum(_digits(value)) % 10 == 0)
        out = F.when(fits, F.lit(name)).otherwise(out)
    return out


def _hash(key: str, kind: Column, value: Column, attempt: int) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, F.lit(str(attempt))), 256)


def _byte(digest: Column, i: Column) -> Column:
    """The i-th pseudo-random byte; beyond the digest it is mixed with the round, so long values vary."""
    at = (i % 31) * 2 + 1
    return (F.conv(F.substring(digest, at, F.lit(2)), 16, 10).cast("int") + F.floor(i / 31).cast("int") * 37) % 256


def _alike(text: Column, digest: Column) -> Column:
    """Every letter and digit of ``text`` exchanged for one of its case and script."""

    def exchanged(c: Column, i: Column) -> Column:
        out = c
        for alphabet in (*GREEK, *CYRILLIC, *LATIN, "0123456789"):
            pick = F.substring(F.lit(alphabet), _byte(digest, i) % len(alphabet) + 1, F.lit(1))
            out = F.when(F.instr(F.lit(alphabet), c) > 0, pick).otherwise(out)
        lower = F.substring(F.lit(LATIN[0]), _byte(digest, i) % 26 + 1, F.lit(1))
        accented = c.rlike(r"^[À-ɏ]$")
        return F.when(accented, F.when(F.lower(c) == c, lower).otherwise(F.upper(lower))).otherwise(out)

    return F.array_join(F.transform(F.split(text, ""), exchanged), "")


def surrogate(kind: Column, value: Column, key: str, attempt: int) -> Column:
    """The surrogate of one part at one attempt."""
    digest = _hash(key, kind, value, attempt)
    more = F.substring(digest, 41, attempt - WIDEN + 2) if attempt >= WIDEN else F.lit("")
    local = F.concat(_alike(F.substring_index(value, "@", 1), digest), more)
    email = F.concat(local, F.lit("@example."), F.element_at(F.array(*map(F.lit, ("com", "net", "org"))), _byte(digest, F.lit(30)) % 3 + 1))
    octet = lambda i: (_byte(digest, F.lit(i)) % 254 + 1).cast("string")
    ip = F.concat_ws(".", *(octet(i) for i in range(4)))
    ssn = F.concat(F.lit("9"), F.substring(_alike(value, digest), 2, 10))
    country = F.regexp_extract(value, r"^(\+[0-9]{1,3}(?=[ .(-]))?", 0)
    phone = F.concat(country, _alike(F.substring(value, F.length(country) + 1, F.length(value)), digest))
    body = F.substring(_alike(value, digest), F.lit(1), F.length(value) - 1)
    check = (10 - _luhn_sum(_digits(F.concat(body, F.lit("0")))) % 10) % 10
    card = F.concat(body, check.cast("string"))
    # Names: at least three syllable-like letters; the ending tells the gender in its script.
    stem = F.concat(_alike(value, digest), F.lower(F.translate(more, "0123456789", "aeiouaeiou")))
    cyrillic = value.rlike(r"^\p{IsCyrillic}")
    greek = value.rlike(r"^\p{IsGreek}")
    ending = F.when(kind == "given_f", F.when(cyrillic, "а").when(greek, "α").otherwise("a")).when(
        kind == "given_m", F.when(cyrillic, "он").when(greek, "ος").otherwise("on")
    )
    name = F.concat(stem, F.coalesce(ending, F.lit("")))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ssn", ssn)
        .when(kind == "phone", phone).when(kind == "card", card).otherwise(name)
    )


def assigned(parts: DataFrame, key: str) -> DataFrame:
    """kind, value, surrogate for the distinct parts: no two alike, and none equal to an original."""
    originals = stored(parts.select("kind", "value").distinct(), "pii-parts")
    pending, done = originals, None
    for attempt in range(ROUNDS):
        drawn = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), key, attempt))
        owner = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        owner = owner.join(
            originals.withColumnRenamed("value", "surrogate"), ["kind", "surrogate"], "left_anti"
        )
        if done is not None:
            owner = owner.join(done, ["kind", "surrogate"], "left_anti")
        owner = stored(owner.select("kind", "value", "surrogate"), "pii-drawn")
        done = owner if done is None else done.unionByName(owner)
        pending = stored(pending.join(owner, ["kind", "value"], "left_anti"), "pii-pending")
        if pending.isEmpty():
            return done
    raise ValueError(f"surrogates of one kind are used up: {pending.first()['kind']}")


def _words(kind: Column, value: Column) -> Column:
    """Parts of an entity: (kind, value); titles are kept as they are (kind null)."""
    words = F.split(value, " ")
    title = F.regexp_replace(F.element_at(words, 1), r"\.$", "")
    female = title.isin(*FEMALE_TITLES) | F.element_at(words, 1).isin(*FEMALE_NAMES)
    male = title.isin(*MALE_TITLES) | F.element_at(words, 1).isin(*MALE_NAMES)
    titled = title.isin(*FEMALE_TITLES, *MALE_TITLES, *NEUTRAL_TITLES)
    given = F.when(female, "given_f").when(male, "given_m").otherwise("given")
    one = lambda k, v: F.struct(k.cast("string").alias("kind"), v.alias("value"))

    def named(w: Column, i: Column) -> Column:
        of = F.when((i == 0) & titled, F.lit(None)).when(i == F.size(words) - 1, "surname").otherwise(
            F.when(w.isin(*FEMALE_NAMES), "given_f").when(w.isin(*MALE_NAMES), "given_m").otherwise(given)
        )
        return one(of, w)

    return F.when(kind == "name", F.transform(words, named)).otherwise(F.array(one(kind, value)))


def _found(text: Column, pattern: str) -> tuple[Column, Column]:
    """The pieces between the matches, and the matches with their kinds."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.split(text, pattern, -1), F.transform(found, lambda v: F.struct(v.alias("value"), _kind(v).alias("kind")))


def _marked(pieces: Column, entities: Column) -> Column:
    """The text with a mark before every refused run of digits."""
    mark = lambda e: F.when(e["kind"].isNull(), F.lit(_MARK)).otherwise(F.lit(""))
    match = lambda e: F.when(e.isNull(), F.lit("")).otherwise(F.concat(mark(e), e["value"]))
    parts = F.zip_with(pieces, entities, lambda p, e: F.concat(F.replace(p, F.lit(_SIGN), F.lit(_ESCAPED)), match(e)))
    return F.array_join(parts, "")


def _unmarked(piece: Column) -> Column:
    return F.replace(F.replace(piece, F.lit(_MARK), F.lit("")), F.lit(_ESCAPED), F.lit(_SIGN))


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in its text, and two columns: n_entities and entity_kinds (kind: count pairs).

    Where a column of ``docs`` has one of those names it is replaced.
    """
    own = [c for c in docs.columns if c not in ("text", "n_entities", "entity_kinds")]
    text = F.col("text").cast("string")
    pieces, entities = _found(text, ANY)
    held = docs.where(text.rlike(ANY)).select(
        F.struct(*own).alias("own"),
        F.monotonically_increasing_id().alias("row"),
        pieces.alias("pieces"),
        entities.alias("entities"),
    )
    refused = F.exists("entities", lambda e: e["kind"].isNull())
    held = held.withColumn("again", F.when(refused, _marked(F.col("pieces"), F.col("entities"))))
    pieces, entities = _found(F.col("again"), AGAIN)
    held = held.select(
        "own",
        "row",
        F.when(F.col("again").isNull(), F.col("pieces")).otherwise(F.transform(pieces, _unmarked)).alias("pieces"),
        F.when(F.col("again").isNull(), F.col("entities")).otherwise(entities).alias("entities"),
    )
    held = stored(held, "pii-texts")
    parts = held.select("row", F.posexplode("entities").alias("n", "e"))
    parts = parts.select("row", "n", "e.kind", F.posexplode(_words(F.col("e.kind"), F.col("e.value"))).alias("w", "p"))
    parts = parts.select("row", "n", "w", F.col("kind").alias("entity"), "p.kind", "p.value")
    pool = assigned(parts.where("kind IS NOT NULL"), key)
    # One row per part on the right, so adaptive execution can cut the rows of a part that is everywhere.
    parts = parts.join(pool, ["kind", "value"], "left")
    new = F.coalesce("surrogate", "value")
    entities = parts.groupBy("row", "n", "entity").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("w", new.alias("new")))), lambda x: x["new"]), " ").alias("new")
    )
    entities = entities.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("n", "new", "entity"))).alias("entities")
    )
    rebuilt = held.drop("entities").join(entities, "row", "left").withColumn(
        "entities", F.coalesce("entities", F.array().cast(entities.schema["entities"].dataType))
    )
    whole = F.array_join(
        F.zip_with("pieces", F.transform("entities", lambda e: e["new"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))),
        "",
    )
    kinds = F.transform("entities", lambda e: e["entity"])

    def counted(name: str) -> Column:
        n = F.size(F.filter(kinds, lambda k: k == name))
        return F.when(n > 0, F.concat_ws(":", F.lit(name), n))

    counts = F.concat_ws(",", *(counted(name) for name, _ in KINDS))
    n_entities = F.size(F.filter(kinds, lambda k: k.isNotNull())).cast("long")
    changed = rebuilt.select("own.*", whole.alias("text"), n_entities.alias("n_entities"), counts.alias("entity_kinds"))
    rest = docs.where(text.isNull() | ~text.rlike(ANY)).select(
        *own, text.alias("text"), F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("entity_kinds")
    )
    return changed.unionByName(rest)
