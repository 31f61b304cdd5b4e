"""Surrogates for personal data.

Entities are found by patterns: secrets, mail addresses, access keys, IP addresses, card, social security and phone numbers, and
names after a title, whose parts are then also replaced where they stand alone in the same text. Each distinct entity gets one keyed surrogate of its type: digits for digits and letters for letters in
the same format, card numbers with a valid check digit where the original has one, names of the same gender and script. The same value gets
the same surrogate in all texts and formats; the parts of a name are entities of their own, so "Ms Anna Weber" and "Ms Weber" stay one
person. A surrogate that two entities share, or that is itself a real entity of the table, is drawn anew until none is.

Only distinct entities are shuffled, and the texts that have any. A map from the entities of a text to their surrogates joins by the
text's digest, so a copied text is solved once. A text without entities is passed through by a filter.

Defined results: null and empty texts stay as they are, repeated rows are treated alike, further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, table
from .registry import query

# fixed values: titles by gender, and syllables of invented names by script
MALE = ("Mr", "Herr", "Señor", "Monsieur", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "г-жа")
LATIN = "ba be bo da de do fa fe ga go ha he jo ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa se so ta te to va ve".split()
CYRILLIC = "ба бе бо ва ве во га да де до ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то".split()
ENDINGS = {("latin", "m"): "lin rik ton mar".split(), ("latin", "f"): "lina rita tonia mara".split(), ("latin", "n"): "wald berg mann feld".split(),
           ("cyrillic", "m"): "слав мир".split(), ("cyrillic", "f"): "слава мира".split(), ("cyrillic", "n"): "енко ских".split()}

_TITLE = "(?:" + "|".join(sorted(MALE + FEMALE, key=len, reverse=True)) + ")"
_PARTICLE = "(?:(?:van|von|der|den|de|da|di|du|del|la|le|zu|ter|ten|bin|ibn|al) )*"
_NAME = r"(?:\p{Lu}\p{L}+(?:['’\-]\p{Lu}\p{L}*)*+|\p{Lu}(?:['’\-]\p{Lu}\p{L}+)++|\p{Lu}\.(?= \p{Lu}))"
#: Country codes, for numbers without separators.
_COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9]\d\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "secret": r"(?<![A-Za-z])(?i:password|passwd|pwd|token|secret|api_?key)\s?[=:]\s?\"?[A-Za-z0-9+/_\-]{8,}",
    "mail": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+",
    "key": r"(?<![A-Za-z0-9])(?:A(?:KIA|SIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    "ip6": rf"(?<![\w:.])(?=[A-Fa-f:]*\d|(?:[A-Fa-f]*:+){{3}}[A-Fa-f])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:(?:{_HEX}:){{0,5}}(?:\d{{1,3}}\.){{3}}\d{{1,3}}|{_HEX}(?::{_HEX}){{0,6}})?)(?![\w:]|\.\d)",
    "card": r"(?<![\w.\-])(?:\d{4}(?:[ \-]\d{4}){2}[ \-]\d{1,7}|\d{13,19})(?!\w)",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "phone": r"(?<![\w.])(?:(?:\+?\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]\d{3,4}|\+\d{1,3}(?:[ .\-]\d{2,4}){2,4}|\+[1-9]\d{6,14}|\d{3}[ .\-]\d{3}[ .\-]\d{4})(?!\w)",
    "name": rf"(?<!\p{{L}}){_TITLE}\.? {_PARTICLE}{_NAME}(?: {_PARTICLE}(?!{_TITLE}(?!\p{{L}})){_NAME}){{0,4}}",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text that does not match this has no entity; it is much cheaper to test.
HINT = rf"[0-9@]|::|AKIA|ASIA|gh[pousr]_|sk-|(?i:password|passwd|pwd|token|secret|api_?key)|{_TITLE}"
#: The part of a match that is replaced, where something stands before it; a phone number keeps its country code.
VALUE = {"phone": rf"(?<=^\+\d{{1,3}})[ .\-(].*$|(?<=^\+{_COUNTRY})\d+$|^[^+].*$|^\+.{{0,2}}$", "secret": r"[A-Za-z0-9+/_\-]{8,}$", "key": r"(?<=AKIA|ASIA|gh[pousr]_|sk-).*$", "name": r"(?<= )\p{Lu}.*$"}


def entities(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), 0)).otherwise(F.array().cast("array<string>"))


def _kind(match: Column) -> Column:
    return F.coalesce(*[F.when(match.rlike(f"^(?:{p})$"), k) for k, p in PATTERNS.items()], F.lit("secret"))


def _long_ip(value: Column) -> Column:
    """The eight groups of an address without leading zeros, so that all its forms are one."""
    def groups(part: Column) -> Column:
        return F.filter(F.split(part, ":"), lambda x: x != "")

    left, right = groups(F.substring_index(value, "::", 1)), F.when(value.contains("::"), groups(F.substring_index(value, "::", -1))).otherwise(F.array().cast("array<string>"))
    zeros = F.greatest(F.lit(0), F.lit(8) - F.size(left) - F.size(right) - F.when(value.contains("."), 1).otherwise(0))
    return F.array_join(F.transform(F.concat(left, F.array_repeat(F.lit("0"), zeros), right), lambda x: F.regexp_replace(x, "^0+(?=.)", "")), ":")


def _parts(name: Column) -> Column:
    """The parts of a name; small words before one belong to it."""
    return F.split(name, r"(?<! \p{Ll}{1,4}) ")


def _units(match: Column, kind: Column) -> Column:
    """The parts of a match that have surrogates: (kind, canon), in order."""
    value = F.coalesce(*[F.when(kind == k, F.regexp_extract(match, p, 0)) for k, p in VALUE.items()], match)
    digits = F.regexp_replace(value, r"\D", "")
    canon = F.when(kind.isin("card", "ssn", "phone"), digits).when(kind == "mail", F.lower(match)).when(kind == "ip6", _long_ip(F.lower(match))).otherwise(value)
    female = match.rlike(f"^(?:{'|'.join(sorted(FEMALE, key=len, reverse=True))})(?![\\p{{L}}])")
    parts = _parts(value)
    given = F.when(female, "given-f").otherwise("given-m")
    names = F.transform(parts, lambda x, i: F.struct(F.when(i + 1 < F.size(parts), given).otherwise("family").alias("kind"), F.lower(x).alias("canon")))
    return F.when(kind == "name", names).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"))))


def _letter(digest: Column, i: Column, pool: str) -> Column:
    return F.substring(F.lit(pool), F.pmod(F.xxhash64(digest, i), F.lit(len(pool))).cast("int") + 1, F.lit(1))


def _shaped(value: Column, digest: Column) -> Column:
    """Characters of the same classes; a value of hexadecimal digits stays one."""
    hexa = value.rlike("^[0-9a-f]*$")
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(c.rlike("[0-9]"), _letter(digest, i, "0123456789"))
        .when(c.rlike("[a-z]"), F.when(hexa, _letter(digest, i, "abcdef")).otherwise(_letter(digest, i, "abcdefghijklmnopqrstuvwxyz")))
        .when(c.rlike("[A-Z]"), _letter(digest, i, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c)), "")


def _luhn(digits: Column) -> Column:
    """Sum of the check-digit rule; valid if it ends in 0."""
    d = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(d, F.lit(0), lambda s, x: s + x) % 10


def _card(value: Column, digest: Column) -> Column:
    body = F.concat(F.left(value, F.lit(1)), F.substring(_shaped(value, digest), F.lit(2), F.char_length(value) - 2))
    check = F.pmod(F.lit(10) - _luhn(F.concat(body, F.lit("0"))), F.lit(10))
    other = (check + 1 + F.pmod(F.xxhash64(digest, F.lit("check")), F.lit(9)).cast("int")) % 10
    return F.concat(body, F.when(_luhn(value) == 0, check).otherwise(other).cast("string"))


def _name(kind: Column, value: Column, digest: Column, attempt: Column) -> Column:
    def pick(i: int, pool: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in pool]), F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(len(pool))).cast("int") + 1)

    def build(script: str, pool: list[str]) -> Column:
        end = F.coalesce(*[F.when(kind == k, pick(9, ENDINGS[script, g])) for k, g in (("given-m", "m"), ("given-f", "f"), ("family", "n"))])
        # each attempt adds a syllable, so there are always enough names
        more = F.array_join(F.transform(F.sequence(F.lit(0), attempt), lambda i: F.element_at(
            F.array(*[F.lit(x) for x in pool]), F.pmod(F.xxhash64(digest, i + 100), F.lit(len(pool))).cast("int") + 1)), "")
        return F.concat(pick(1, pool), pick(2, pool), more, end)

    return F.when(value.rlike(r"\p{IsCyrillic}"), build("cyrillic", CYRILLIC)).otherwise(build("latin", LATIN))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Keyed surrogate of a canonical value, in canonical form."""
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, canon, attempt.cast("string")).cast("binary"), 256)
    octets = F.concat_ws(".", *[(F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(254)) + 1).cast("string") for i in range(4)])
    groups = F.concat(F.lit("2001:db8:"), F.concat_ws(":", *[F.substring(digest, F.lit(4 * i + 1), F.lit(4)) for i in range(6)]))
    local = F.substring_index(canon, "@", 1)
    domain = F.element_at(F.array(*[F.lit(f"example.{x}") for x in ("com", "net", "org")]), F.pmod(F.xxhash64(digest, F.lit("d")), F.lit(3)).cast("int") + 1)
    # a short value leaves few of its shape, so later attempts make mail names longer
    longer = F.when(attempt > 2, F.substring(digest, F.lit(1), attempt)).otherwise("")
    return (
        F.when(kind == "ip", octets).when(kind == "ip6", groups).when(kind == "mail", F.concat(_shaped(local, digest), longer, F.lit("@"), domain))
        .when(kind == "card", _card(canon, digest)).when(kind.isin("given-m", "given-f", "family"), _name(kind, canon, digest, attempt))
        .otherwise(_shaped(canon, digest))
    )


def _poured(match: Column, digits: Column) -> Column:
    """``digits`` in the places of the digits of ``match``."""
    state = F.struct(F.lit("").alias("out"), F.lit(1).alias("i"))
    return F.aggregate(F.split(match, ""), state, lambda s, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substring(digits, s["i"], F.lit(1))).alias("out"), (s["i"] + 1).alias("i"))
    ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["i"].alias("i"))), lambda s: s["out"])


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(match, new, names) for the distinct matches ``found(match)``, without collisions; names: (size, pattern, new) of each part of a name."""
    kinds = found.withColumn("kind", _kind(F.col("match")))
    units = cut(kinds.select("match", "kind", F.posexplode(_units(F.col("match"), F.col("kind"))).alias("i", "u")).select(
        "match", F.col("kind").alias("whole"), "i", "u.kind", "u.canon"))
    real = cut(units.select("kind", "canon").distinct())
    open_, done = real.withColumn("attempt", F.lit(0)), None
    taken = real.select(F.col("canon").alias("new"))
    while True:
        drawn = cut(open_.withColumn("new", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key)))
        first = drawn.groupBy("new").agg(F.min(F.struct("kind", "canon")).alias("w")).join(taken, "new", "left_anti")
        won = cut(drawn.join(first, "new").where("w.kind = kind and w.canon = canon").select("kind", "canon", "new"))
        done = won if done is None else done.unionByName(won)
        taken = taken.unionByName(won.select("new"))
        lost = cut(drawn.join(won.select("kind", "canon"), ["kind", "canon"], "left_anti"))
        if not lost.take(1):
            break
        open_ = lost.select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
    new = units.join(done, ["kind", "canon"]).groupBy("match", "whole").agg(F.array_sort(F.collect_list(F.struct("i", "new"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: F.when(F.col("whole") == "name", F.initcap(x["new"])).otherwise(x["new"])), " ")
    head = F.coalesce(*[F.when(F.col("whole") == k, F.regexp_replace("match", p, "")) for k, p in VALUE.items()], F.lit(""))
    body = F.substring("match", F.char_length(head) + 1, F.char_length("match"))
    alone = F.filter(F.arrays_zip(_parts(body).alias("part"), F.col("p").alias("p")), lambda x: x["part"].rlike(r"\p{L}{2}|['’\-]"))
    pattern = F.transform(alone, lambda x: F.struct(-F.char_length(x["part"]), F.concat(
        F.lit(r"(?<![\p{L}\p{N}_])"), F.regexp_replace(x["part"], r"^((?:\p{Ll}+ )+)", r"(?:$1)?"), F.lit(r"(?![\p{L}\p{N}_])")), F.initcap(x["p"]["new"])))
    names = F.when(F.col("whole") == "name", pattern).otherwise(F.array()).cast("array<struct<size:int,re:string,new:string>>")
    return new.select("match", F.when(F.col("whole").isin("card", "ssn", "phone"), F.concat(head, _poured(body, joined))).otherwise(F.concat(head, joined)).alias("new"), names.alias("names"))


def replace_entities(docs: DataFrame, key: str = "surrogates", text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``count`` names a column for the number of replaced entities."""
    cols = [c for c in docs.columns if c != count]
    e, k, m, own = (fresh(docs, x) for x in ("_e", "_k", "_m", "_own"))
    t = F.col(f"`{text}`")
    rows = docs.select(*[F.col(f"`{c}`") for c in cols], entities(t).alias(e))
    has = F.coalesce(F.size(e) > 0, F.lit(False))
    digest = F.sha2(t.cast("binary"), 256)
    solved = cut(rows.where(has).select(digest.alias(k), F.explode(e).alias("match")).distinct())
    maps = solved.join(surrogates(solved.select("match").distinct(), key), "match").groupBy(k).agg(
        F.map_from_entries(F.collect_list(F.struct("match", "new"))).alias(m),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias(own))
    between = F.split(t, PATTERN, -1)

    def bare(x: Column) -> Column:
        """A piece between matches, with names of this text that stand there without a title."""
        return F.aggregate(own, x, lambda s, p: F.regexp_replace(s, p["re"], p["new"]))

    mended = F.array_join(F.transform(between, lambda x, i: F.concat(bare(x), F.coalesce(F.element_at(m, F.get(e, i)), F.lit("")))), "")
    dirty = rows.where(has).withColumn(k, digest).join(maps, k)
    rest = F.array_join(between, "\n")
    more = F.size(F.split(rest, F.array_join(F.col(own)["re"], "|"), -1)) - 1
    n = [] if count is None else [(F.size(e) + F.when(F.size(own) > 0, more).otherwise(0)).cast("bigint").alias(count)]
    changed = dirty.select(*[mended.alias(c) if c == text else F.col(f"`{c}`") for c in cols], *n)
    zero = [] if count is None else [F.lit(0).cast("bigint").alias(count)]
    return rows.where(~has).select(*[F.col(f"`{c}`") for c in cols], *zero).unionByName(changed)


@query("op9_surrogates")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return replace_entities(docs, count="n_entities").select("doc_id", "text", "n_entities")
