"""Surrogates for personal data: keyed, of the same type and format, and never two alike.

Entities are e-mail addresses, phone numbers, card numbers, social security
numbers, bank accounts, IPv4 addresses and names of persons. An entity is its
kind and its canonical form (digits only, lower case, ...), so all ways to write
one get one surrogate, in the format of each mention: digits are poured into
the mention's own punctuation, capitals stay capitals, a valid card or account
check digit is valid again. Given names keep gender and script, family names
script and ending. Addresses lie in ranges reserved for examples.

A surrogate is a function of key, entity and attempt number. Two entities may
draw the same one, or one that is itself an entity of the corpus. So distinct
entities claim their surrogates in rounds: a claim on a taken one, or on a real
value, fails; of several claims on one the smallest keyed hash wins; losers try
the next attempt. From attempt ``WIDEN`` on surrogates get longer than their
format, so a format without free values ends no run. Practically all succeed at
once. An account counts only with valid check digits; else it is prose. The documents are then
rewritten by expression, with attempt number 0 except for those few entities
that a small table lists; no text is shuffled unless that table is large.

Defined cases: null and empty texts stay as they are. Very long texts are
treated whole. Equal rows stay equal. An empty table gives an empty result.
Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.functions.signature import hmac_sha256_hex
from devmetrics.llm.staging import Workspace

KEY = b"devmetrics surrogate key"

# The attempt from which surrogates are longer than their format, which may have no free value left.
WIDEN = 20

# Given names that are recognised, and those that stand in for them: no name is in both.
NAMES = {
    "female": (
        "Anna Maria Laura Julia Emma Sophie Clara Sarah Emily Alice Helen Lucia Carmen Camille Charlotte Margarita",
        "Amelia Beatrice Cecilia Dorothea Eleonora Fiona Gloria Henrietta Isabella Josephine Katharina Lydia "
        "Miranda Natalie Olivia Penelope Rosalind Susanna Theodora Ursula Valentina Winifred Yvonne Zelda",
    ),
    "male": (
        "John Peter Thomas Michael David Daniel James Robert William Henry Carlos Miguel Pablo Pierre Hans Lukas",
        "Albert Benedict Conrad Dominic Edmund Frederick Gregory Hubert Ignatius Jasper Kenneth Leopold "
        "Maurice Norbert Oswald Patrick Quentin Roderick Sebastian Tobias Ulrich Vincent Walter Xavier",
    ),
    "female_cyrillic": (
        "Анна Мария Ольга Елена Наталья Ирина Татьяна Светлана",
        "Варвара Галина Дарья Жанна Зинаида Кира Лариса Нина Полина Раиса Тамара Ульяна",
    ),
    "male_cyrillic": (
        "Иван Пётр Сергей Алексей Дмитрий Николай Андрей Михаил",
        "Борис Виктор Георгий Егор Захар Кирилл Леонид Матвей Олег Роман Степан Фёдор",
    ),
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Señor Señora Monsieur Madame Господин Госпожа"
SYLLABLES = "ba be bo da de do fa fe fo ga go ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to"
SYLLABLES_CYRILLIC = "ба бе бо ва во га го да де до за зе ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та то"

_GIVEN = "|".join(n for names, _ in NAMES.values() for n in names.split())
_TITLE = "|".join(TITLES.split())
EMAIL = r"(?<![A-Za-z0-9._+\-])[A-Za-z0-9._+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP = rf"(?<![\w.])(?=[0-9])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.[0-9])"
SSN = r"(?<![\w\-])(?=[0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w\-])"
PHONE = (
    r"(?<![\w+])(?=[+(0-9])(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){1,4}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}|[0-9]{3}([.\-])[0-9]{3}\1[0-9]{4})(?!\w)"
)
CARD = r"(?<!\w)(?=[0-9])(?:[0-9]{13,19}|(?:[0-9]{4}[ \-]){3}[0-9]{4})(?!\w)"
IBAN = r"(?<!\w)(?=[A-Z]{2}[0-9]{2})[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
GIVEN = rf"(?<!\p{{L}})(?=\p{{Lu}})(?:{_GIVEN})(?= \p{{Lu}}\p{{Ll}})"
FAMILY = rf"(?<= )(?=\p{{Lu}}\p{{Ll}})(?<=(?:{_GIVEN}|(?:{_TITLE})\.?) )\p{{Lu}}\p{{Ll}}+"
# Where two kinds fit, the first in this order counts.
PATTERNS = {
    "email": EMAIL, "iban": IBAN, "ssn": SSN, "ip": IP, "phone": PHONE, "card": CARD, "given": GIVEN, "family": FAMILY,
}
NO_IBAN = "|".join(p for kind, p in PATTERNS.items() if kind != "iban")

DIGITS = ("ssn", "phone", "card")


def _kind(mention: Column) -> Column:
    """The kind of a mention, by its own form alone."""
    digits = F.regexp_replace(mention, "[^0-9]", "")
    out = F.when(mention.contains("@"), "email")
    out = out.when(mention.rlike(r"^[A-Z]{2}[0-9]{2}[ A-Z0-9]+$"), "iban")
    out = out.when(mention.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
    out = out.when(mention.rlike(r"^[0-9]+(\.[0-9]+){3}$") & (F.length(digits) <= 12), "ip")
    out = out.when(mention.rlike(r"^[0-9]{13,19}$|^([0-9]{4}[ -]){3}[0-9]{4}$"), "card")
    out = out.when(mention.rlike(r"^[+(0-9]"), "phone")
    for kind, (names, _) in NAMES.items():
        out = out.when(mention.isin(*names.split()), kind)
    return out.otherwise(F.when(mention.rlike(r"^\p{IsCyrillic}"), "family_cyrillic").otherwise("family"))


def _canonical(mention: Column, kind: Column) -> Column:
    digits = F.regexp_replace(mention, "[^0-9]", "")
    return (
        F.when(kind.isin("ssn", "card"), digits)
        .when(kind == "phone", F.concat(F.when(mention.startswith("+"), "+").otherwise(""), digits))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "family_cyrillic", F.regexp_replace(F.lower(mention), "а$", ""))
        .otherwise(F.lower(mention))
    )


def _hex(key: bytes, *of: Column) -> Column:
    return hmac_sha256_hex(key, F.encode(F.concat_ws("\x1f", *(x.cast("string") for x in of)), "UTF-8"))


def _at(text: Column, i: Column, n: int = 1) -> Column:
    return F.substr(text, i, F.lit(n))


def _number(hexes: Column, start: int, n: int) -> Column:
    return F.conv(F.substring(hexes, start, n), 16, 10).cast("bigint")


def _chars(text: Column, each) -> Column:
    """``text`` with each character replaced by ``each(character, place)``."""
    made = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: each(_at(text, i), i))
    return F.when(F.length(text) > 0, F.array_join(made, "")).otherwise("")


def _stream(hexes: Column) -> Column:
    """64 digits out of 64 hex characters."""
    return F.translate(hexes, "abcdef", "806142")


def _remainder(digits: Column, modulus: int) -> Column:
    return F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda r, i: (r * 10 + _at(digits, i).cast("int")) % modulus
    )


def luhn(digits: Column) -> Column:
    """The check sum of a card number; 0 if it is valid."""

    def weighed(i):
        d = _at(digits, i).cast("int") * (1 + (F.length(digits) - i) % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: (s + weighed(i)) % 10)


def _wider(stream: Column, attempt: Column) -> Column:
    """What a surrogate gets besides its format: 8 to 24 digits."""
    return F.when(attempt >= WIDEN, F.substr(stream, F.lit(33), F.least(attempt - WIDEN + 8, F.lit(24)))).otherwise("")


def _card(value: Column, stream: Column, wider: Column) -> Column:
    body = F.concat(_at(value, F.lit(1)), F.substr(stream, F.lit(1), F.length(value) - 2), wider)
    check = ((10 - luhn(F.concat(body, F.lit("0")))) % 10).cast("string")
    return F.when(luhn(value) == 0, F.concat(body, check)).otherwise(
        F.concat(body, ((check.cast("int") + 1 + F.substring(stream, 40, 1).cast("int") % 9) % 10).cast("string"))
    )


def _mod97(moved: Column) -> Column:
    numeric = _chars(moved, lambda c, i: F.when(c.rlike("[0-9]"), c).otherwise((F.ascii(c) - 55).cast("string")))
    return _remainder(numeric, 97)


def _iban(value: Column, hexes: Column, stream: Column, wider: Column) -> Column:
    drawn = _chars(
        F.substring(value, 5, 40),
        lambda c, i: F.when(c.rlike("[0-9]"), _at(stream, i)).otherwise(F.upper(_letter(hexes, i))),
    )
    body, country = F.concat(drawn, wider), F.substring(value, 1, 2)
    check = F.lpad((98 - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
    return F.concat(country, check, body)


def _accounts(text: Column) -> Column:
    """The bank accounts of a text as written: at each possible start the longest with valid check digits."""

    def valid(m, end):
        bare = F.regexp_replace(F.substr(m, F.lit(1), end), " ", "")
        return _mod97(F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))) == 1

    def longest(m):
        ends = F.filter(
            F.sequence(F.length(m), F.lit(15), F.lit(-1)),
            lambda i: ((i == F.length(m)) | (_at(m, i + 1) == " ")) & valid(m, i),
        )
        return F.substr(m, F.lit(1), F.get(ends, F.lit(0)))

    starts = F.regexp_extract_all(text, F.lit(f"(?=({IBAN}))"), 1)
    return F.filter(F.transform(F.array_distinct(starts), longest), lambda m: m.isNotNull())


def _pattern(text: Column) -> Column:
    """The pattern of all entities of a text; of accounts it has those that are valid, the longer first."""
    any_of = F.array_join(F.sort_array(_accounts(text), asc=False), "|")
    rest = NO_IBAN.removeprefix(EMAIL)
    full = F.concat(F.lit(rf"{EMAIL}|(?<!\w)(?:"), any_of, F.lit(rf")(?!\w){rest}"))
    return F.when(any_of != "", full).otherwise(F.lit(NO_IBAN))


def _letter(hexes: Column, i: Column) -> Column:
    return F.chr(97 + F.conv(_at(hexes, (i * 2 - 1) % 62 + 1, 2), 16, 10).cast("int") % 26)


def _email(value: Column, hexes: Column, of: Column, attempt: Column) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    stream = _stream(hexes)
    shaped = _chars(
        local,
        lambda c, i: F.when(c.rlike("[0-9]"), _at(stream, (i - 1) % 64 + 1)).when(c.rlike("[a-z]"), _letter(hexes, i)).otherwise(c),
    )
    # A short address has few surrogates of its own form: later attempts grow.
    longer = F.when(attempt > 3, F.concat(F.lit("."), F.substring(stream, 50, 8), _wider(stream, attempt))).otherwise("")
    host = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: _letter(of, i)), "")
    end = F.regexp_extract(domain, r"\.(com|net|org)$", 1)
    return F.concat(shaped, longer, F.lit("@"), host, F.lit(".example."), F.when(end == "", "com").otherwise(end))


def _ip(hexes: Column, wider: Column) -> Column:
    """An address of the reserved range 240.0.0.0 to 253.255.255.255, with a fifth number if wider."""
    parts = [240 + _number(hexes, 1, 4) % 14, *(_number(hexes, k, 2) for k in (5, 7, 9))]
    return F.concat_ws(".", *(p.cast("string") for p in parts), F.nullif(wider, F.lit("")))


def _given(kind: str, hexes: Column, attempt: Column) -> Column:
    pool = F.array(*(F.lit(n.lower()) for n in NAMES[kind][1].split()))
    size = len(NAMES[kind][1].split())
    # Behind the whole list each round has an ending of its own.
    rounds = F.floor(attempt / size)
    ending = F.when(rounds > 0, F.translate(rounds.cast("string"), "0123456789", "aeiounrlst")).otherwise("")
    return F.concat(F.get(pool, ((_number(hexes, 1, 6) + attempt) % size).cast("int")), ending)


def _family(hexes: Column, attempt: Column, syllables: str, end: str) -> Column:
    pool = F.array(*(F.lit(s) for s in syllables.split()))
    made = F.transform(
        F.sequence(F.lit(1), F.lit(3) + (attempt / 2).cast("int")),
        lambda i: F.get(pool, (F.conv(_at(hexes, (i * 2 - 1) % 62 + 1, 2), 16, 10).cast("int") % len(syllables.split()))),
    )
    return F.concat(F.array_join(made, ""), F.lit(end))


def _with(items: Column, fields: list[str], name: str, made) -> Column:
    """An array of structs with one more field.

    Each step is a pass of its own over the array, so a field is computed once
    however often the next one uses it.
    """
    return F.transform(items, lambda x: F.struct(*(x[f].alias(f) for f in fields), made(x).alias(name)))


def _surrogates(items: Column, fields: list[str], key: bytes) -> Column:
    """Adds the canonical ``surrogate`` to entities with kind, value and attempt."""
    # Given names walk through their list from a keyed place on; all others draw anew.
    items = _with(
        items, fields, "hexes",
        lambda x: _hex(key, x["kind"], x["value"], F.when(x["kind"].isin(*NAMES), F.lit(0)).otherwise(x["attempt"])),
    )
    items = _with(
        items, [*fields, "hexes"], "domain",
        lambda x: F.when(x["kind"] == "email", _hex(key, F.lit("domain"), F.substring_index(x["value"], "@", -1))),
    )
    items = _with(items, [*fields, "hexes", "domain"], "stream", lambda x: _stream(x["hexes"]))

    def one(x):
        kind, value, hexes, stream, attempt = (x[f] for f in ("kind", "value", "hexes", "stream", "attempt"))
        phone = F.when(value.startswith("+"), F.substring(value, 1, 2)).otherwise("")
        wider = _wider(stream, attempt)
        out = (
            F.when(kind == "email", _email(value, hexes, x["domain"], attempt))
            .when(kind == "ip", _ip(hexes, wider))
            .when(kind == "ssn", F.concat(F.lit("9"), F.substring(stream, 1, 8), wider))
            .when(kind == "phone", F.concat(phone, F.substr(stream, F.lit(1), F.length(value) - F.length(phone)), wider))
            .when(kind == "card", _card(value, stream, wider))
            .when(kind == "iban", _iban(value, hexes, stream, wider))
        )
        for name in NAMES:
            out = out.when(kind == name, _given(name, hexes, attempt))
        return out.when(kind == "family_cyrillic", _family(hexes, attempt, SYLLABLES_CYRILLIC, "в")).otherwise(
            _family(hexes, attempt, SYLLABLES, "r")
        )

    return _with(items, [*fields, "hexes", "domain", "stream"], "surrogate", one)


def surrogate(kind: Column, value: Column, attempt: Column, key: bytes = KEY) -> Column:
    """The canonical surrogate of an entity at an attempt."""
    fields = ["kind", "value", "attempt"]
    item = F.struct(kind.alias("kind"), value.alias("value"), attempt.alias("attempt"))
    return F.get(_surrogates(F.array(item), fields, key), F.lit(0))["surrogate"]


def rendered(mention: Column, kind: Column, canonical: Column) -> Column:
    """A canonical surrogate in the format of the mention it replaces."""

    def pour(acc, i):
        c = _at(mention, i)
        free = c.rlike("[A-Z0-9]")
        return F.struct(
            F.concat(acc["text"], F.when(free, _at(acc["left"], F.lit(1))).otherwise(c)).alias("text"),
            F.when(free, F.substring(acc["left"], 2, 99)).otherwise(acc["left"]).alias("left"),
        )

    start = F.struct(F.lit("").alias("text"), F.regexp_replace(canonical, r"\+", "").alias("left"))
    poured = F.aggregate(F.sequence(F.lit(1), F.length(mention)), start, pour, lambda acc: F.concat(acc["text"], acc["left"]))
    upper = (F.upper(mention) == mention) & (F.length(mention) > 1)
    ending = F.when((kind == "family_cyrillic") & mention.endswith("а"), "а").otherwise("")
    name = F.concat(F.initcap(canonical), ending)
    return (
        F.when(kind.isin("ssn", "phone", "card", "iban"), poured)
        .when(kind == "ip", canonical)
        .when(kind == "email", F.when(upper, F.upper(canonical)).otherwise(canonical))
        .otherwise(name)
    )


def _found(text: Column) -> Column:
    return F.regexp_extract_all(text, _pattern(text), 0)


def _named(found: Column) -> Column:
    """(mention, kind, value) of each mention."""
    items = F.transform(found, lambda m: F.struct(m.alias("mention")))
    items = _with(items, ["mention"], "kind", lambda x: _kind(x["mention"]))
    return _with(items, ["mention", "kind"], "value", lambda x: _canonical(x["mention"], x["kind"]))


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct entities (kind, value) of all texts."""
    each = docs.select(F.explode(F.array_distinct(_found(F.col(text)))).alias("mention"))
    one = each.distinct().select(F.get(_named(F.array("mention")), F.lit(0)).alias("x"))
    return one.select("x.kind", "x.value").distinct()


def attempts(known: DataFrame, work: Workspace, key: bytes = KEY) -> DataFrame:
    """(kind, value, attempt) of the entities whose first surrogate is not free."""
    names = [*NAMES, "family", "family_cyrillic"]
    pending = known.withColumn("attempt", F.lit(0))
    taken = known.filter(~F.col("kind").isin(*names)).select("kind", F.col("value").alias("surrogate"))
    later = None
    for step in count():
        made = surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key)
        claims = pending.withColumn("surrogate", made).filter(F.col("surrogate") != F.col("value"))
        claims = claims.join(taken, ["kind", "surrogate"], "left_anti")
        rank = F.struct(F.xxhash64("value", "kind"), F.col("value"), F.col("attempt"))
        won = claims.groupBy("kind", "surrogate").agg(F.min(rank).alias("best"))
        won = work.write(
            won.select("kind", F.col("best.value").alias("value"), F.col("best.attempt").alias("attempt"), "surrogate"),
            f"won{step}",
        )
        late = won.filter("attempt > 0").select("kind", "value", "attempt")
        later = late if later is None else later.unionByName(late)
        taken = taken.unionByName(won.select("kind", "surrogate"))
        lost = pending.join(won.select("kind", "value"), ["kind", "value"], "left_anti")
        pending = work.write(lost.withColumn("attempt", F.col("attempt") + 1), f"lost{step}")
        if pending.isEmpty():
            return work.write(later, "later")


def pseudonymised(
    docs: DataFrame, key: bytes = KEY, text: str = "text", mentions: str | None = None
) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced; ``mentions`` names a column for their number."""
    work = Workspace(docs.sparkSession)
    known = work.write(entities(docs, text), "entities")
    later = attempts(known, work, key)

    df = docs.select(F.struct("*").alias("__row"), F.col(text).alias("__text"))
    df = df.withColumn("__found", F.coalesce(_found(F.col("__text")), F.array().cast("array<string>")))
    # The few entities with a later attempt, per text that mentions one.
    if later.isEmpty():
        df = df.withColumn("__later", F.expr("CAST(map() AS map<string,int>)"))
    else:
        named = later.select(F.concat_ws(":", "kind", "value").alias("entity"), "attempt")
        prints = df.select(
            F.xxhash64("__text").alias("__print"),
            F.explode(F.transform(_named(F.col("__found")), lambda x: F.concat_ws(":", x["kind"], x["value"]))).alias("entity"),
        ).distinct()
        hit = prints.join(named, "entity").groupBy("__print").agg(
            F.map_from_entries(F.collect_list(F.struct("entity", "attempt"))).alias("__later")
        )
        hit = work.write(hit, "later_by_text")
        df = df.withColumn("__print", F.xxhash64("__text")).join(hit, "__print", "left")
        df = df.withColumn("__later", F.coalesce("__later", F.expr("CAST(map() AS map<string,int>)")))

    fields = ["mention", "kind", "value", "attempt"]
    items = _with(
        _named(F.col("__found")), fields[:3], "attempt",
        lambda x: F.coalesce(F.try_element_at("__later", F.concat_ws(":", x["kind"], x["value"])), F.lit(0)),
    )
    items = _surrogates(items, fields, key)
    replaced = F.transform(items, lambda x: rendered(x["mention"], x["kind"], x["surrogate"]))
    between = F.split("__text", _pattern(F.col("__text")), -1)
    new = F.zip_with(between, replaced, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    changed = F.when(F.size("__found") > 0, F.array_join(new, "")).otherwise(F.col("__text"))
    columns = [changed.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns]
    if mentions:
        columns.append(F.size("__found").cast("bigint").alias(mentions))
    return df.select(*columns)
