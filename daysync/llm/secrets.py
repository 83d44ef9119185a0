"""Secrets in texts, told apart by who owns them, in DataFrame functions only.

Every text is scanned for assignments, access keys and hex strings, and for opaque tokens.
The hashes of all candidates are counted over the corpus by distinct repositories and
owners: a value that many owners have was copied from documentation, one that a single
owner has and that looks random is a live credential. Opaque tokens count only if they are
that; the other kinds are always reported, with their status.

Positions are code points. Functions that find them split a text at its matches, in one
pass: the pieces from one match's end to the next one's, the rest of the text last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daysync.llm.common import fresh, stored

# Kinds in the order of the results, and their forms.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# A run of 20 or more with a digit and a letter; only its start is tried.
TOKEN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "token")
LEAST_ASSIGNED = 6

#: A value that more owners have is an example.
MOST_OWNERS = 2
#: Of a live value, the bits per character by how often each occurs.
LEAST_BITS = 2.5

_SPAN = "struct<start:int,nth:int,end:int,value:string>"


def _spans(text: Column, form: str, nth: int) -> Column:
    """``start, nth, end, value`` of all matches, from left to right without overlap.

    value is the form's group, or the whole match where it has none.
    """
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).*?(?:{form}|\z)"), F.lit(0))
    group = 1 if form is ASSIGN else 0
    none = F.array().cast(f"array<{_SPAN}>")

    def step(done: Column, piece: Column) -> Column:
        size, match = F.char_length(piece), F.regexp_extract(piece, rf"(?:{form})\z", 0)
        value = F.regexp_extract(piece, rf"(?:{form})\z", group)
        end = done["at"] + size
        span = F.struct((end - F.char_length(match)).alias("start"), F.lit(nth).alias("nth"), end.alias("end"), value.alias("value"))
        return F.struct(end.alias("at"), F.when(match != "", F.concat(done["spans"], F.array(span.cast(_SPAN)))).otherwise(done["spans"]).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(text.rlike(form), F.aggregate(pieces, start, step)["spans"]).otherwise(none)


def _bits(value: Column) -> Column:
    """Entropy of a value's characters."""
    letters = F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))
    size = F.size(letters)

    def part(letter: Column) -> Column:
        p = F.size(F.filter(letters, lambda x: x == letter)) / size
        return -p * F.log2(p)

    return F.aggregate(F.transform(F.array_distinct(letters), part), F.lit(0.0), lambda a, b: a + b)


def candidates(text: Column) -> Column:
    """All spans of a text by start and kind; tokens only where no other kind is."""
    base = F.concat(
        F.filter(_spans(text, ASSIGN, 0), lambda s: F.char_length(s["value"]) >= LEAST_ASSIGNED),
        _spans(text, ACCESS, 1),
        _spans(text, HEX, 2),
    )

    def apart(spans: Column, tokens: Column) -> Column:
        clear = F.filter(tokens, lambda t: ~F.exists(spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
        return F.array_sort(F.concat(spans, clear))

    # Bound once: an array of one, transformed.
    both = F.array(F.struct(base.alias("base"), _spans(text, TOKEN, 3).alias("tokens")))
    return F.element_at(F.transform(both, lambda x: apart(x["base"], x["tokens"])), 1)


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    owner: Column | None = None,
    repository: Column | None = None,
    most_owners: int = MOST_OWNERS,
) -> DataFrame:
    """``id`` and ``secrets`` of each row of ``docs``.

    A secret has kind, start, end, base, status (live, example or weak), owners and
    repositories: how many have its value. Secrets go by start, then kind. base is false for
    opaque tokens, which are there only when live.

    Null and empty texts have none. A null owner or repository is one of its own. Rows that
    repeat each give a row; so do rows without id. Other columns are read only by ``owner``
    (the column ``source`` unless given) and ``repository``, and not returned. An empty table
    gives an empty result.
    """
    owner = F.col("source") if owner is None else owner
    repository = owner if repository is None else repository
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    found = stored(
        docs.select(
            F.col(id_column).alias("id"), F.xxhash64(owner).alias("owner"), F.xxhash64(repository).alias("repository"),
            F.transform(candidates(text), lambda s: F.struct(
                s["start"].alias("start"), s["nth"].alias("nth"), s["end"].alias("end"),
                F.sha2(s["value"], 256).alias("hash"), (_bits(s["value"]) >= LEAST_BITS).alias("random"),
            )).alias("spans"),
        ).withColumn("row", F.monotonically_increasing_id())
    )
    some = found.where(F.size("spans") > 0)
    each = some.select("id", "row", "owner", "repository", F.explode("spans").alias("span"))
    held = each.select(F.col("span.hash").alias("hash"), "owner", "repository").distinct()
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    counted = stored(by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")))

    status = F.when(F.col("owners") > most_owners, "example").when(F.col("span.random"), "live").otherwise("weak")
    judged = each.withColumn("hash", F.col("span.hash")).join(counted, "hash").withColumn("status", status)
    judged = judged.where((F.col("span.nth") < 3) | (F.col("status") == "live"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    secret = F.struct(
        F.col("span.start").alias("start"), F.col("span.nth").alias("nth"), F.element_at(kinds, F.col("span.nth") + 1).alias("kind"),
        F.col("span.end").alias("end"), (F.col("span.nth") < 3).alias("base"), "status", "owners", "repositories",
    )
    lists = judged.groupBy("row").agg(F.array_sort(F.collect_list(secret)).alias("secrets"))
    (name,) = fresh(["id"], "row")
    placed = some.select("id", F.col("row").alias(name)).join(lists, "row", "left")
    none = found.where(F.size("spans") == 0).select("id", F.lit(None).cast(lists.schema["secrets"].dataType).alias("secrets"))
    return placed.select("id", "secrets").unionByName(none).withColumn("secrets", F.coalesce("secrets", F.array().cast(lists.schema["secrets"].dataType)))
