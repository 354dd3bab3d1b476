"""Personal data and secrets replaced by keyed surrogates, in SQL expressions only.

Entities are found by patterns. Each distinct one, in its canonical form (case and separators
aside), gets one surrogate drawn from a keyed hash: digits become digits, letters letters
of the same script and case, hexadecimal strings stay hexadecimal, a card number keeps its
Luhn validity, mail domains end in the reserved ``example`` and are shared by the addresses of one
domain, names follow the gender of their title. A secret is what follows a name such as password or token, with
ten blanks at most on either side of the sign between them. So mentions of one entity stay one,
in any document and any spelling.

Surrogates are checked over the whole corpus: one that another entity of the type holds, or that is an
entity found in the texts, is drawn anew until all are distinct. Where the surrogates of an entity's own
length run short, they get longer by one character (two digits of a card number, one octet, one name) with
every further draw. Domains with one name and different endings have surrogates of their own; two
domains can draw the same one, two addresses can't.

A text's replacement depends on the text alone. Texts with entities are joined to their
replacements by two 64-bit hashes; the others are passed on where they were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utxolake.llm.common import stored

KEY = "surrogates"
#: Draws in the entity's own length; each later one is longer.
OWN_LENGTH_DRAWS = 4

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"\p{Lu}[\p{L}'\-]+"
_FEMALE = "Mrs|Ms|Miss|Frau|Mme|Madame|Señora|Sra|Госпожа"
_MALE = "Mr|Herr|Monsieur|Señor|Sr|Господин"
_PERSON = "Dr|Prof|Professor|Доктор|Профессор"
_TITLES = (("female", _FEMALE), ("male", _MALE), ("person", _PERSON))
_MAIL = r"[\p{L}\p{N}._%+\-]++@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}"
_HEX = r"[0-9A-Fa-f]{1,4}"
_IP6 = rf"(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}"
_CARD = r"\d{13,19}|\d{4}(?:[ \-]\d{4}){3}|\d{4}[ \-]\d{6}[ \-]\d{5}"
#: Names of values that are secret whatever they are, and of those that are if they hold a digit.
_PASSWORD, _SECRET = "password|passwd|pwd|passphrase", r"secret|token|api[_\-]?key|access[_\-]?key|private[_\-]?key"
_GIVEN = r"(?=[A-Za-z0-9_\-!@#$%^*+/=~?.]{{8}})(?<=[=:][ \t]{{0,10}}[\"']?)(?<=(?i:{})[\"']?[ \t]{{0,10}}[=:][ \t]{{0,10}}[\"']?)"
_VALUE = r"[A-Za-z0-9_\-!@#$%^*+/=~?.]{7,}[A-Za-z0-9_\-=]"
# Kinds of entities and their patterns, tried in this order at each place.
PATTERNS = (
    ("secret", _GIVEN.format(_PASSWORD) + _VALUE),
    ("secret", _GIVEN.format(_SECRET) + r"(?=[A-Za-z_\-!@#$%^*+/=~?.]*+\d)" + _VALUE),
    ("key", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("email", rf"(?<![\p{{L}}\p{{N}}._%+\-]){_MAIL}(?![A-Za-z0-9])"),
    ("ip", rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"),
    ("ip6", rf"(?<![\p{{L}}\p{{N}}:])(?:{_IP6})(?![\p{{L}}\p{{N}}:])"),
    ("ssn", r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("card", rf"(?<![\d\-])(?:{_CARD})(?![\d\-])"),
    ("phone", r"(?<![\d+])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\) ?|\d{3}[.\-])\d{3,4}[ .\-]?\d{3,4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)"
              r"|(?<![\d+.\-])\d{3} \d{3} \d{4}(?![\d.\-])|(?<![\p{L}\d+.\-])1[3-9]\d{9}(?![\p{L}\d.\-])"),
    *((kind, rf"(?=\p{{Lu}})(?<= )(?<=(?<!\p{{L}})(?:{titles})[.]? ){_NAME}(?: {_NAME}){{0,2}}") for kind, titles in _TITLES),
)
ENTITY = "|".join(f"(?:{p})" for _, p in PATTERNS)
#: Without one of these a text holds no entity.
HINT = rf"[0-9@]|AKIA|::|(?i:{_PASSWORD})|{_FEMALE}|{_MALE}|{_PERSON}"
_DIGITS = ("ssn", "card", "phone")
_NAMES = ("female", "male", "person")
_SYLLABLES = {
    "latin": "ba be bi da de do fa ga ka ke ki la le li lo ma me mi na ne ni no pa ra re ri ro sa se si ta te ti to va ve vi".split(),
    "cyrillic": "ба бе би да де до га ка ке ки ла ле ли ло ма ме ми на не ни но па ра ре ри ро са се си та те ти то ва ве ви".split(),
}
_ENDINGS = {("person", "latin"): "el", ("person", "cyrillic"): "ел", ("female", "latin"): "na", ("male", "latin"): "ton", ("female", "cyrillic"): "на", ("male", "cyrillic"): "тон"}


def _kind(entity: Column) -> Column:
    """The first kind whose whole pattern, without its surroundings, an entity found has."""
    key = entity.rlike(r"^AKIA[A-Z0-9]{16}$")
    out = F.when(entity.rlike(rf"^{_MAIL}$"), "email").when(key, "key").when(entity.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip").when(entity.rlike(rf"^(?:{_IP6})$"), "ip6")
    out = out.when(entity.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(entity.rlike(rf"^(?:{_CARD})$"), "card")
    out = out.when(entity.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$"), "iban")
    return out.when(entity.rlike(r"^[\d+(]") & entity.rlike(r"^[\d+() .\-]+$"), "phone").when(entity.rlike(r"\d"), "secret").otherwise("name")


def _canonical(kind: Column, entity: Column) -> Column:
    digits = F.regexp_replace(entity, r"\D", "")
    out = F.when(kind.isin(*_DIGITS), digits).when(kind == "iban", F.regexp_replace(entity, " ", ""))
    return out.when((kind == "secret") & ~entity.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), entity).when(kind == "key", entity).otherwise(F.lower(entity))


def _stream(*parts: Column) -> Column:
    """1,024 keyed hexadecimal characters for each value: 256 draws. ``_draw`` makes any later one from the first 128."""
    text = F.concat_ws("\x1f", *parts)
    return F.concat(*(F.sha2(F.concat(text, F.lit(f"\x1f{i}")).cast("binary"), 512) for i in range(8)))


def _draw(stream: Column, at: Column, of: int) -> Column:
    """A number below ``of`` from four characters of the stream, or of a hash of it past its end."""
    further = F.substring(F.sha2(F.concat_ws("\x1f", F.substring(stream, 1, 128), at.cast("string")).cast("binary"), 256), 1, 4)
    four = F.when(at < 256, F.substring(stream, (at * 4 + 1).cast("int"), F.lit(4))).otherwise(further)
    return (F.conv(four, 16, 10).cast("int") % of).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), n + 1, F.lit(1))


def _by_class(text: Column, stream: Column) -> Column:
    """Each character redrawn within its class; others kept."""
    def one(c: Column, i: Column) -> Column:
        out = F.when(c.rlike("^[0-9]$"), _draw(stream, i, 10).cast("string"))
        for pattern, alphabet in (
            ("^[a-z]$", "abcdefghijklmnopqrstuvwxyz"), ("^[A-Z]$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            ("^[à-öø-ÿ]$", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"), ("^[а-я]$", "абвгдежзийклмнопрстуфхцчшщъыьэюя"), ("^[α-ω]$", "αβγδεζηθικλμνξοπρσςτυφχψω"),
        ):
            out = out.when(c.rlike(pattern), _pick(alphabet, _draw(stream, i, len(alphabet))))
        return out.otherwise(F.when(c.rlike(r"^\p{L}$"), _pick("abcdefghijklmnopqrstuvwxyz", _draw(stream, i, 26))).otherwise(c))

    return F.array_join(F.transform(F.split(text, "(?<=.)(?=.)"), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of Luhn's rule modulo 10, for a number that its check digit ends."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * (1 + (n - i) % 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10


def _name_maker(stream: Column, parts: Column, n_parts: int, ending: str):
    def word(_: Column, i: Column) -> Column:
        return F.concat(*(F.element_at(parts, _draw(stream, i * 4 + j, n_parts) + 1) for j in range(4)), F.lit(ending))

    return word


def _surrogate(key: str, kind: Column, value: Column, stream: Column) -> Column:
    """The surrogate's canonical form, drawn from a stream."""
    classed = _by_class(value, stream)
    hexadecimal = F.array_join(F.transform(F.split(value, "(?<=.)(?=.)"), lambda c, i: _pick("0123456789abcdef", _draw(stream, i, 16))), "")
    octets = F.array_join(F.transform(F.split(value, "[.]"), lambda _, i: (_draw(stream, i, 254) + 1).cast("string")), ".")
    drawn = F.concat(F.substring(classed, F.lit(1), F.length(value) - 1), F.lit("0"))
    check = (10 - _luhn(drawn)) % 10  # an invalid number gets another last digit
    last = F.when(_luhn(value) == 0, check).otherwise((check + 1 + _draw(stream, F.lit(200), 9)) % 10)
    card = F.concat(F.substring(drawn, F.lit(1), F.length(value) - 1), last.cast("string"))
    domain = _stream(F.lit(key), F.lit("domain"), F.regexp_extract(value, "@(.*)$", 1))
    mail = F.concat(_by_class(F.regexp_extract(value, "^([^@]*)@", 1), stream), F.lit("@"), _by_class(F.regexp_extract(value, "@(.*)[.][^.]*$", 1), domain), F.lit(".example"))
    groups = F.array_join(F.transform(F.split(value, "(?<=.)(?=.)"), lambda c, i: F.when(c == ":", c).otherwise(_pick("0123456789abcdef", _draw(stream, i, 16)))), "")
    phone = F.concat(F.substring(value, 1, 1), F.substring(classed, F.lit(2), F.length(value)))
    out = F.when(kind == "email", mail).when(kind == "ip", octets).when(kind == "ip6", groups).when(kind == "card", card).when(kind == "phone", phone)
    out = out.when(kind == "ssn", F.concat(F.lit("9"), F.substring(classed, F.lit(2), F.length(value)))).when(kind == "key", F.concat(F.lit("AKIA"), F.substring(classed, F.lit(5), F.length(value))))
    out = out.when(kind == "iban", F.concat(F.substring(value, 1, 2), F.substring(classed, F.lit(3), F.length(value))))
    out = out.when((kind == "secret") & value.rlike("^[0-9a-f]+$"), hexadecimal)
    for (gender, script), ending in _ENDINGS.items():
        parts = F.array(*map(F.lit, _SYLLABLES[script]))
        names = F.array_join(F.transform(F.split(value, " "), _name_maker(stream, parts, len(_SYLLABLES[script]), ending)), " ")
        in_script = value.rlike(r"\p{IsCyrillic}") if script == "cyrillic" else ~value.rlike(r"\p{IsCyrillic}")
        out = out.when((kind == gender) & in_script, names)
    return out.otherwise(classed)


def _longer(kind: Column, value: Column, by: int) -> Column:
    """A value in whose form there are more surrogates: ``by`` characters, pairs of digits of a card, octets or names longer."""
    out = F.when(kind == "email", F.regexp_replace(value, "@", "a" * by + "@")).when(kind == "ip", F.concat(value, F.lit(".0" * by)))
    out = out.when(kind == "card", F.concat(value, F.lit("00" * by))).when(kind.isin(*_NAMES), F.concat(value, F.lit(" a" * by)))  # Luhn's sum stays
    return out.when(kind == "key", F.concat(value, F.lit("A" * by))).otherwise(F.concat(value, F.lit("0" * by)))


def _written(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate in the entity's spelling; what it is longer by ends it."""
    gaps = F.split(entity, r"\d", -1)
    digits = F.array_join(F.zip_with(gaps, F.split(surrogate, "(?<=.)(?=.)"), lambda g, d: F.concat(F.coalesce(g, F.lit("")), F.coalesce(d, F.lit("")))), "")
    spaced = F.array_join(F.zip_with(F.split(entity, "[A-Z0-9]", -1), F.split(surrogate, "(?<=.)(?=.)"), lambda g, d: F.concat(F.coalesce(g, F.lit("")), F.coalesce(d, F.lit("")))), "")
    shout = (F.upper(entity) == entity) & (F.lower(entity) != entity)
    out = F.when(kind.isin(*_DIGITS), digits).when(kind == "iban", spaced).when(kind == "key", surrogate)
    out = out.when((kind == "secret") & ~entity.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), surrogate).when(shout, F.upper(surrogate))
    return out.when(kind.isin(*_NAMES), F.initcap(surrogate)).otherwise(surrogate)


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, value, surrogate) of distinct (kind, value): distinct within a kind, and no value of any kind."""
    values = stored(entities.select("kind", "value").distinct(), "entities")
    taken = values.select(F.col("value").alias("surrogate")).distinct()
    draw, settled = 0, None
    left = values
    while True:
        drawn = left.select("kind", "value", _stream(F.lit(key), F.col("kind"), F.col("value"), F.lit(str(draw))).alias("stream"))
        form = _longer(F.col("kind"), F.col("value"), draw - OWN_LENGTH_DRAWS + 1) if draw >= OWN_LENGTH_DRAWS else F.col("value")
        drawn = drawn.select("kind", "value", _surrogate(key, F.col("kind"), form, F.col("stream")).alias("surrogate"))
        # among values that drew the same surrogate the smallest keeps it, unless it is given out or occurs in the texts
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        first = first.join(taken, "surrogate", "left_anti")
        if settled is not None:
            first = first.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        fine = stored(first.select("kind", "value", "surrogate"), "surrogates")
        settled = fine if settled is None else settled.unionByName(fine)
        left = stored(left.join(fine, ["kind", "value"], "left_anti"), "colliding")
        draw += 1
        if left.isEmpty():
            return settled


def _found(text: Column) -> Column:
    """Entities of a text in order, each with its kind."""
    # what stands before an entity without a digit tells a person's title, or that it is a password
    entities = F.regexp_extract_all(text, F.lit(ENTITY), 0)
    before = F.split(text, ENTITY, -1)

    def titled(i: Column) -> Column:
        out = None
        for kind, titles in _TITLES:
            found = F.element_at(before, i + 1).rlike(rf"(?:{titles})[.]? $")
            out = F.when(found, kind) if out is None else out.when(found, kind)
        return out.otherwise("secret")

    return F.transform(entities, lambda e, i: F.struct(F.when(_kind(e) == "name", titled(i)).otherwise(_kind(e)).alias("kind"), e.alias("entity")))


def pseudonymise(docs: DataFrame, *, text_col: str = "text", key: str = KEY, count_col: str | None = None, length_col: str | None = None) -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced; ``count_col`` names a column for their number,
    ``length_col`` a column of ``docs`` that holds the text's characters and follows it where it changes.

    Rows without an entity, with empty or null texts among them, stay as they are. All columns are
    kept, ids play no part. A ``key`` of one's own makes the surrogates one's own.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.col(f"`{text_col}`").cast("string")
    hinted = F.coalesce(text.rlike(HINT), F.lit(False)) & F.coalesce(text.rlike(ENTITY), F.lit(False))
    keyed = docs.select(row, text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2"), hinted.alias("has"))
    texts = keyed.where("has").select("t1", "t2", _found(F.col("text")).alias("found"))
    texts = stored(texts.groupBy("t1", "t2").agg(F.first("found").alias("found")), "found")
    each = texts.select("t1", "t2", F.posexplode("found")).select("t1", "t2", "pos", "col.kind", "col.entity")
    each = each.withColumn("value", _canonical(F.col("kind"), F.col("entity")))
    names = surrogates(each, key)
    new = each.join(names, ["kind", "value"]).select("t1", "t2", F.struct("pos", _written(F.col("kind"), F.col("entity"), F.col("surrogate")).alias("new")).alias("new"))
    new = new.groupBy("t1", "t2").agg(F.transform(F.sort_array(F.collect_list("new")), lambda x: x["new"]).alias("new"))
    pieces = F.split(F.col("text"), ENTITY, -1)
    replaced = F.array_join(F.zip_with(pieces, F.col("new"), lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    changed = keyed.where("has").join(new, ["t1", "t2"]).select("row", replaced.alias("text"), F.size("new").cast("long").alias("n"))
    row = F.col("row").withField(f"`{text_col}`", F.col("text"))
    if length_col:
        row = row.withField(f"`{length_col}`", F.length("text").cast(docs.schema[length_col].dataType))
    changed = changed.select(row.alias("row"), "n")
    same = keyed.where("not has").select("row", F.lit(0).cast("long").alias("n"))
    out = changed.unionByName(same)
    return out.select("row.*", F.col("n").alias(count_col)) if count_col else out.select("row.*")
