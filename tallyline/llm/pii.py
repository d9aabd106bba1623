"""Surrogates for personal data, in column expressions only.

Entities are found by one regular expression per kind and replaced by keyed surrogates of the
same kind and form: digits stay digits, letters keep case and script, separators stay, a card
number keeps its length, first digit and checksum, a phone number its country code, a hex
secret stays hex, an e-mail address gets a reserved domain, a person's name the same gender (by
title or given name) and script.

An entity has a normal form (a phone number without its separators, an address in lower case,
a name by its words), and its surrogate depends on key, kind and normal form only. So an entity
has one surrogate in the whole corpus, whatever its spelling, and a surname the same one with
and without a given name. Distinctness is checked: surrogates are made for the distinct
entities of the corpus, and one that another entity holds, or that is itself an entity there,
is made again with the next attempt until none is left. Within each clash the smallest normal
form keeps the surrogate. Forms grow with the attempt, so that every entity finds one: names get
more parts, and where ``PATIENCE`` attempts failed, as when most numbers of a length are entities,
numbers and secrets get further digits and an IPv6 address is written in full. Only the forms of
IPv4 addresses are bounded, by their 3.7 billion.

Texts without an entity, null and empty ones pass as they are. Repeated rows get the same
result. Other columns are kept; the text column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import Stored

# Titles and given names that tell the gender, and surrogate names by script.
MALE_TITLES = r"Mr|Sir|Herr|Monsieur|Señor|Sr|Signor|г-н|господин|Господин|κ\.|κύριος|Κύριος"
FEMALE_TITLES = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Sra|Signora|г-жа|госпожа|Госпожа|κα|κυρία|Κυρία"
OTHER_TITLES = "Dr|Prof|Professor|Doctor|д-р|доктор|Доктор|δρ|Δρ"
MALE_GIVEN = "James|John|Robert|Michael|William|David|Richard|Thomas|Daniel|Peter|Hans|Klaus|Jean|Pierre|Juan|Carlos|José|Иван|Пётр|Петр|Сергей|Алексей|Дмитрий|Николай|Андрей|Михаил|Александр|Владимир|Γιώργος|Κώστας|Δημήτρης|Γιάννης"
FEMALE_GIVEN = "Mary|Patricia|Jennifer|Linda|Elizabeth|Susan|Sarah|Anna|Emma|Julia|Ursula|Monika|Marie|Sophie|María|Carmen|Lucía|Анна|Мария|Елена|Наталья|Татьяна|Ирина|Екатерина|Светлана|Μαρία|Κατερίνα|Ιωάννα"
NAMES = {
    ("latin", "m"): ["Adam", "Bruno", "Conrad", "Dario", "Edgar", "Felix", "Gustav", "Henry", "Igor", "Karl", "Leon", "Max"],
    ("latin", "f"): ["Alma", "Bella", "Clara", "Diana", "Edith", "Flora", "Greta", "Helen", "Irma", "Karla", "Lena", "Maja"],
    ("latin", "u"): ["Alex", "Chris", "Dana", "Eli", "Jo", "Kim", "Lou", "Nico", "Noa", "Robin", "Sam", "Toni"],
    ("cyrillic", "m"): ["Борис", "Виктор", "Глеб", "Егор", "Захар", "Лев", "Марк", "Олег"],
    ("cyrillic", "f"): ["Алла", "Вера", "Дарья", "Зоя", "Лидия", "Нина", "Ольга", "Тамара"],
    ("cyrillic", "u"): ["Женя", "Саша", "Валя", "Шура"],
    ("greek", "m"): ["Άρης", "Λέων", "Νίκος", "Πέτρος"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ζωή", "Σοφία"],
    ("greek", "u"): ["Λάκης", "Τάκης", "Φωτεινός", "Χρήστου"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fo", "gar", "hil", "ker", "lo", "mar", "nes", "pol", "ros", "sten", "tor", "ul", "wen", "zan"],
    "cyrillic": ["ба", "вен", "гор", "ди", "жар", "кол", "ло", "мир", "нов", "пе", "рас", "тем"],
    "greek": ["βα", "γο", "δη", "κα", "λε", "μα", "νι", "πο", "ρα", "σι", "τα", "φο"],
}

_NAME = r"\p{Lu}[\p{L}’']+(?:-\p{Lu}[\p{L}’']+)?"
_TITLED = rf"(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.? {{1,2}}{_NAME}(?: {_NAME}){{0,2}}"
_GIVEN = rf"(?:{MALE_GIVEN}|{FEMALE_GIVEN}) {_NAME}"
_KEY = r"(?i:password|passwd|pwd|passphrase|token|secret|api[_-]?key|access[_-]?key|private[_-]?key)(?:\d{1,3}|[_.-][\w.-]{0,40})?[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
_HEX = "[0-9A-Fa-f]{1,4}"
_GAP = r"[^\p{L}\p{N}_+\r\n]{0,5}"

#: Kind and pattern, in the order in which they are tried at a place. No group is repeated without
#: a bound: the regular expressions of the JVM take stack for every turn of one.
PATTERNS: list[tuple[str, str]] = [
    ("secret", rf"(?=[aApPsStT]){_KEY}[A-Za-z0-9+/_\-.]{{6,}}"),
    ("email", r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]{1,64}@(?:[\p{L}\p{N}\-]+\.){1,30}\p{L}{2,}"),
    ("person", rf"(?=[A-ZА-ЯЁΆ-Ωгдκδ])(?<![\p{{L}}\p{{N}}_])(?:{_TITLED}|{_GIVEN})"),
    ("iban", r"(?=[A-Z])\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ipv6", rf"(?<![\w:])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[A-Fa-f:]*\d)(?:(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?:{_HEX}:){{1,7}}:|::(?:{_HEX}:){{0,6}}{_HEX}))(?![\w:])"),
    ("ip", r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", rf"(?<![\w+])(?:\+\d{{1,3}}{_GAP}(?:\(\d{{1,4}}\){_GAP})?\d{{2,4}}(?:{_GAP}\d{{2,5}}){{1,4}}(?!\d)|(?:1[-. ]?)?\(\d{{3}}\) ?\d{{3}}[-. ]\d{{4}}(?!\d)|(?:1[-. ])?\d{{3}}[-. ]\d{{3}}[-. ]\d{{4}}(?!\d))"),
    ("card", r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"),
]
ANY = "|".join(p for _, p in PATTERNS)
#: Kinds that cannot occur without a character, or a class of them.
NEEDS = {"secret": "[=:]", "email": "@", "person": None}
#: Kinds whose separators are form: their normal form has letters and digits only.
SPACED = ["iban", "ssn", "phone", "card"]
#: Attempts after which a surrogate of a fixed form gets longer.
PATIENCE = 10
#: Marks around an entity while a text is cut; the second serves texts that hold the first.
MARKS = ("\ue000\ue001", "\ue002\ue003\ue002")


def mentions(text: Column) -> Column:
    """Whether a text has an entity. Cheap signs come first, as most texts have none of them."""
    found = F.lit(False)
    rest = "|".join(p for kind, p in PATTERNS if kind not in NEEDS)
    groups = [(NEEDS[kind], p) for kind, p in PATTERNS if kind in NEEDS] + [("[0-9]", rest)]
    for sign, pattern in groups:
        found = found | (text.rlike(sign) & text.rlike(pattern) if sign else text.rlike(pattern))
    return F.coalesce(found, F.lit(False))


def kind_of(surface: Column) -> Column:
    """The kind of a matched text: the first pattern that covers all of it."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS):
        out = F.when(surface.rlike(rf"\A(?:{pattern})\z"), F.lit(kind)).otherwise(out)
    return F.coalesce(out, F.lit("card"))


def cut(text: Column) -> Column:
    """A text as an array: what lies between entities at even places, entities at odd ones."""
    mark = F.when(F.instr(text, MARKS[0]) == 0, F.lit(MARKS[0])).otherwise(F.lit(MARKS[1]))
    marked = F.regexp_replace(text, F.lit(ANY), F.concat(mark, F.lit("$0"), mark))
    return F.split(marked, F.concat(F.lit(r"\Q"), mark, F.lit(r"\E")), -1)


def script_of(text: Column) -> Column:
    return (
        F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    )


def _number(digest: Column, at: Column | int, limit: int) -> Column:
    """A number below ``limit``, drawn from a digest for a place."""
    return F.pmod(F.xxhash64(digest, F.lit(at) if isinstance(at, int) else at), F.lit(limit)).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _redraw(text: Column, digest: Column, keep: Column | int = 0, hexadecimal: Column | None = None) -> Column:
    """Each letter and digit after the first ``keep`` drawn anew, of the same class and case."""
    lower = "abcdefghijklmnopqrstuvwxyz"
    some = F.lit(6) if hexadecimal is None else F.when(hexadecimal, 6).otherwise(26)

    def one(c: Column, i: Column) -> Column:
        letter = F.substr(F.lit(lower), F.pmod(F.xxhash64(digest, i), some if hexadecimal is not None else F.lit(26)).cast("int") + 1, F.lit(1))
        return (
            F.when(i < keep, c)
            .when(c.rlike("[0-9]"), _number(digest, i, 10).cast("string"))
            .when(c.rlike(r"\p{Lu}"), F.upper(letter))
            .when(c.rlike(r"\p{L}"), letter)
            .otherwise(c)
        )

    return F.array_join(F.transform(_chars(text), one), "")


def _luhn(digits: Column) -> Column:
    """The sum of the Luhn check; a valid number has a multiple of ten."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(F.pmod(n - i, F.lit(2)) == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(digits: Column, digest: Column, more: Column) -> Column:
    drawn = F.concat(_redraw(digits, digest, keep=1), more)
    head = F.substr(drawn, F.lit(1), F.length(drawn) - 1)
    check = F.pmod(F.lit(10) - F.pmod(_luhn(F.concat(head, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    return F.when(F.pmod(_luhn(digits), F.lit(10)) == 0, F.concat(head, check)).otherwise(drawn)


def _pick(values: list[str], digest: Column, parts: Column) -> Column:
    """So many of the values, drawn from a digest."""
    listed = F.array(*[F.lit(v) for v in values])
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.element_at(listed, _number(digest, i, len(values)) + 1))


def _given(gender: str, text: Column, digest: Column, attempt: Column) -> Column:
    """A given name of a gender; later attempts have more parts."""
    out = F.lit(None).cast("string")
    for script in ("latin", "greek", "cyrillic"):
        parts = F.floor(attempt / 3).cast("int") + 1 + F.greatest(F.lit(0), attempt - PATIENCE)
        name = F.array_join(_pick(NAMES[script, gender], digest, parts), "-")
        out = F.when(script_of(text) == script, name).otherwise(out)
    return out


def _surname(text: Column, digest: Column, attempt: Column) -> Column:
    out = F.lit(None).cast("string")
    for script in ("latin", "greek", "cyrillic"):
        name = F.initcap(F.array_join(_pick(SYLLABLES[script], digest, attempt + 3), ""))
        out = F.when(script_of(text) == script, name).otherwise(out)
    return out


def _octets(digest: Column) -> Column:
    first = _number(digest, 0, 222) + 1
    return F.concat_ws(".", *[x.cast("string") for x in (first, *(_number(digest, i, 256) for i in (1, 2, 3)))])


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a normal form at an attempt."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string")).cast("binary"), 256)
    domain = F.substring_index(norm, "@", -1)
    of_domain = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("domain"), domain).cast("binary"), 256)
    tld = F.substring_index(domain, ".", -1)
    host = F.concat(
        F.translate(F.substr(of_domain, F.lit(1), F.lit(12)), "0123456789", "ghijklmnop"),
        F.when(tld.isin("com", "net", "org"), F.concat(F.lit(".example."), tld)).otherwise(F.lit(".example.com")),
    )
    local = F.substring_index(norm, "@", 1)
    pad = F.lower(F.translate(F.substr(digest, F.lit(1), F.least(F.lit(24), attempt * 4)), "0123456789", "ghijklmnop"))
    extra = F.greatest(F.lit(0), attempt - PATIENCE)
    drawn = F.transform(F.sequence(F.lit(0), extra), lambda i: _number(digest, i + 1000, 10).cast("string"))
    more = F.array_join(F.slice(drawn, F.lit(1), extra), "")
    full = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substr(digest, 4 * i + 1, F.lit(4))), ":")
    code = F.when(norm.startswith("+"), F.lit(2)).when(norm.rlike(r"\A1\d{10}\z"), F.lit(1)).otherwise(F.lit(0))
    return (
        F.when(kind == "email", F.concat(_redraw(local, digest), pad, F.lit("@"), host))
        .when(kind == "ip", _octets(digest))
        .when(kind == "card", _card(norm, digest, more))
        .when(kind == "phone", F.concat(_redraw(norm, digest, keep=code), more))
        .when(kind == "iban", F.concat(_redraw(norm, digest, keep=2), more))
        .when(kind == "ipv6", F.when(extra > 0, full).otherwise(_redraw(norm, digest, hexadecimal=F.lit(True))))
        .when(kind == "secret", F.concat(_redraw(norm, digest, hexadecimal=norm.rlike(r"\A[0-9a-fA-F]+\z")), more))
        .when(kind == "given_m", _given("m", norm, digest, attempt))
        .when(kind == "given_f", _given("f", norm, digest, attempt))
        .when(kind == "given_u", _given("u", norm, digest, attempt))
        .when(kind == "surname", _surname(norm, digest, attempt))
        .otherwise(F.concat(_redraw(norm, digest), more))
    )


def entities(surface: Column) -> Column:
    """``array<struct(kind, norm)>``: what a matched text mentions; a name has two parts at most."""
    kind = kind_of(surface)
    one = lambda k, n: F.struct(k.alias("kind"), n.alias("norm"))
    spaced = F.regexp_replace(surface, r"[^\p{L}\p{N}+]", "")
    value = F.regexp_replace(surface, rf"\A{_KEY}", "")
    title = F.regexp_extract(surface, rf"\A((?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.? {{1,2}})", 1)
    name = F.substr(surface, F.length(title) + 1)
    has_given = F.instr(name, " ") > 0
    given, surname = F.substring_index(name, " ", 1), F.substring_index(name, " ", -1)
    gender = (
        F.when(title.rlike(rf"\A(?:{MALE_TITLES})(?!\p{{L}})"), "m")
        .when(title.rlike(rf"\A(?:{FEMALE_TITLES})(?!\p{{L}})"), "f")
        .when(given.rlike(rf"\A(?:{MALE_GIVEN})\z"), "m")
        .when(given.rlike(rf"\A(?:{FEMALE_GIVEN})\z"), "f")
        .otherwise("u")
    )
    last = one(F.lit("surname"), F.lower(surname))
    first = one(F.concat(F.lit("given_"), gender), F.lower(given))
    return (
        F.when(kind == "person", F.when(has_given, F.array(last, first)).otherwise(F.array(last)))
        .when(kind.isin(SPACED), F.array(one(kind, spaced)))
        .when(kind == "secret", F.array(one(kind, value)))
        .otherwise(F.array(one(kind, F.lower(surface))))
    )


def _render(surface: Column, found: Column, subs: Column) -> Column:
    """The replacement of a matched text, given the surrogates of its entities in order."""
    kind, new = found[0]["kind"], subs[0]
    ordinal = lambda i: F.length(F.regexp_replace(F.substr(surface, F.lit(1), i + 1), r"[^\p{L}\p{N}+]", ""))
    spread = F.array_join(
        F.transform(
            _chars(surface), lambda c, i: F.when(c.rlike(r"[\p{L}\p{N}+]"), F.substr(new, ordinal(i), F.lit(1))).otherwise(c)
        ),
        "",
    )
    rest = F.substr(new, F.length(F.regexp_replace(surface, r"[^\p{L}\p{N}+]", "")) + 1)
    prefix = F.regexp_extract(surface, rf"\A({_KEY})", 1)
    title = F.regexp_extract(surface, rf"\A((?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.? {{1,2}})", 1)
    person = F.concat(title, F.when(F.size(subs) > 1, F.concat(subs[1], F.lit(" "))).otherwise(F.lit("")), new)
    return (
        F.when(kind.isin(SPACED), F.concat(spread, rest))
        .when(kind == "secret", F.concat(prefix, new))
        .when(kind == "surname", person)
        .otherwise(new)
    )


def dictionary(found: DataFrame, store: Stored, key: str) -> DataFrame:
    """``kind, norm, sub`` for the distinct ``kind, norm``, all surrogates of a kind distinct."""
    family = F.when(F.col("kind").startswith("given"), F.lit("given")).otherwise(F.col("kind")).alias("family")
    real = store.put(found.groupBy("kind", "norm").agg(F.count("*").alias("n")).select("kind", "norm", family), "entities")
    taken = real.select("family", F.lower("norm").alias("form")).distinct()
    made = real.withColumn("attempt", F.lit(0)).withColumn("settled", F.lit(False))
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        # Few bytes and much work: dealt to a set number of tasks, which are not put together again.
        made = made.repartition(tasks, "kind", "norm")
        made = made.withColumn("sub", surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key))
        made = store.put(made.withColumn("form", F.lower("sub")), "made")
        # The keeper of each surrogate: one that had it before, else the smallest normal form.
        keep = made.groupBy("family", "form").agg(
            F.min(F.struct((~F.col("settled")).alias("late"), "kind", "norm")).alias("keeper")
        )
        keep = keep.join(taken.withColumn("real", F.lit(True)), ["family", "form"], "left")
        checked = made.join(keep, ["family", "form"]).withColumn(
            "settled",
            F.col("real").isNull() & (F.col("keeper.kind") == F.col("kind")) & (F.col("keeper.norm") == F.col("norm")),
        )
        checked = store.put(checked.select("kind", "norm", "family", "attempt", "settled", "sub"), "surrogates")
        if checked.where(~F.col("settled")).limit(1).count() == 0:
            return checked.select("kind", "norm", "sub")
        made = checked.withColumn("attempt", F.col("attempt") + F.when(F.col("settled"), 0).otherwise(1)).drop("sub")


def replace(docs: DataFrame, text_col: str = "text", key: str = "surrogates") -> DataFrame:
    """The same rows and columns, with surrogates for the personal data in the text column.

    Only texts with an entity are shuffled: cut once, looked up by entity, put together by the
    digest of the text, so that copies share the work. All others pass through.
    """
    store = Stored(docs.sparkSession)
    text = F.col(text_col)
    hit = mentions(text)
    columns = docs.columns
    dirty = docs.where(hit).withColumn("_pii_key", F.sha2(text.cast("binary"), 256)).withColumn("_pii_cut", cut(text))
    dirty = store.put(dirty, "dirty")
    spans = (
        dirty.select("_pii_key", F.posexplode("_pii_cut").alias("at", "surface"))
        .where("at % 2 = 1")
        .groupBy(F.col("_pii_key").alias("key"), "at", "surface")
        .agg(F.count("*").alias("n"))
        .withColumn("found", entities(F.col("surface")))
    )
    spans = store.put(spans.select("key", "at", "surface", "found"), "spans")
    named = spans.select("key", "at", "surface", "found", F.posexplode("found").alias("k", "e")).select(
        "key", "at", "surface", "found", "k", "e.kind", "e.norm"
    )
    subs = dictionary(named.select("kind", "norm"), store, key)
    put = (
        named.join(subs, ["kind", "norm"])
        .groupBy("key", "at", "surface", "found")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "sub"))), lambda x: x["sub"]).alias("subs"))
        .select("key", "at", _render(F.col("surface"), F.col("found"), F.col("subs")).alias("new"))
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_list(F.struct("at", "new"))).alias("_pii_new"))
    )
    whole = F.array_join(
        F.transform("_pii_cut", lambda part, i: F.coalesce(F.element_at("_pii_new", i), part)), ""
    )
    done = dirty.join(put.withColumnRenamed("key", "_pii_key"), "_pii_key").withColumn(text_col, whole)
    return docs.where(~hit).select(*columns).unionByName(done.select(*columns))
