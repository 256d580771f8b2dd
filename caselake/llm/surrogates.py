"""PII surrogates (operator 6), DataFrame operations only.

Detected entities get keyed replacements of their own type: digits stay digits in the same
punctuation, a card number keeps its network digit and a valid check digit, an address keeps its top
domain, octets keep their number of digits, hexadecimal secrets stay hexadecimal, and names keep
script, gender (from the title) and capitals. One entity gets one surrogate wherever and however it
is written (coreference): the surrogate depends on the key and on a canonical form, and e-mail
domains and name parts are replaced by themselves, so that "Ms. Ada Reed" and "Ms. Reed" agree.

Collision checks: all distinct entities of the corpus are listed. Where two would share a surrogate,
or a surrogate equals an entity that exists, all but one move on to their next surrogate, until no
clash is left. After ``PLAIN_ATTEMPTS`` moves surrogates get longer with every move, so that there are
always enough of them and the rounds end. Only entities that moved need a lookup; every other surrogate is computed in place,
so the texts are not shuffled.

Defined results: null and empty texts, and texts without entities, stay as they are; repeated rows
get equal results; an empty table gives no rows; other columns are carried along unread.
Numbers that look like cards but fail the check digit are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselake.llm.registry import query, table
from caselake.session import materialise

KEY = "surrogate-key-1"  # production sets its own secret
BROADCAST_ROWS = 500_000
PLAIN_ATTEMPTS = 4  # surrogates after more moves are longer, by a letter or digit a move

MALE, FEMALE, ANY = ("Mr", "Herr", "Señor", "Monsieur", "г-н"), ("Mrs", "Ms", "Frau", "Señora", "Madame", "г-жа"), ("Dr", "Prof")
_TITLE = "(?:" + "|".join(sorted((*MALE, *FEMALE, *ANY), key=len, reverse=True)) + ")"
_NAME = rf"(?<![\p{{L}}\d]){_TITLE}\.? \p{{Lu}}\p{{Ll}}+(?:[- ]\p{{Lu}}\p{{Ll}}+)?(?!\p{{L}})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "card": r"(?<![\d.+-])(?:(?:\d{4}[ -]){3}\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\d])",
    "access": r"(?<![A-Z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<=(?i:password|passwd|pwd|token|secret|api_key|apikey)[\"']?\s{0,2}[=:]\s{0,2}[\"']?)(?=[_/+=-]*+[A-Za-z0-9])[A-Za-z0-9_/+=-]{8,}",
    "name": _NAME,
}
_HEXADECIMAL = "^(?:[0-9a-f]+|[0-9A-F]+)$"
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def may_hold(text: Column) -> Column:
    """False for texts that cannot hold an entity: no digit, no sign of an address or a secret, no title."""
    hint = text.rlike("[0-9@=:]")
    for title in (*MALE, *FEMALE, *ANY):
        hint = hint | text.contains(f"{title} ") | text.contains(f"{title}. ")
    return F.coalesce(hint, F.lit(False))


# name parts by script; the end tells the gender of given names
PARTS = {
    "latin": (["bel", "dor", "fen", "gal", "har", "jor", "kel", "lan", "mar", "nor", "per", "ros", "sel", "tam", "ul", "vel"], ["o", "us", "en"], ["a", "ia", "ine"], ["man", "ford", "ley", "son"]),
    "cyrillic": (["бел", "дор", "вен", "гал", "зар", "кам", "лад", "мир", "нор", "рад", "сел", "тим", "вел", "жар", "пет", "ром"], ["ан", "ий", "ор"], ["ана", "ия", "ина"], ["енко", "ских", "ук", "ко"]),
    "greek": (["αλ", "βερ", "γαλ", "δορ", "ζαν", "θελ", "καλ", "λαμ", "μαρ", "νικ", "παλ", "ροδ", "σελ", "τιμ", "φιλ", "χαρ"], ["ος", "ης", "ας"], ["α", "η", "ια"], ["ιδης", "ακης", "ου", "ας"]),
}

# lower-case letters of other scripts with capitals: first, last, step
ALPHABETS = [
    "".join(map(chr, range(first, last + 1, step)))
    for first, last, step in (
        (0x561, 0x586, 1), (0x10D0, 0x10F0, 1), (0xAB70, 0xABBF, 1), (0x2D00, 0x2D25, 1), (0x2C30, 0x2C5E, 1), (0x2C81, 0x2CB1, 2), (0x10428, 0x1044F, 1),
        (0x104D8, 0x104FB, 1), (0x10CC0, 0x10CF2, 1), (0x118C0, 0x118DF, 1), (0x16E60, 0x16E7F, 1), (0x1E922, 0x1E943, 1),
    )
]
_OTHER = "[" + "".join(ALPHABETS) + "]"
LATIN, CYRILLIC, GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхц", "αβγδεζηικλμνοπρστυφχω"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once: expressions of expressions would grow without bound."""
    return F.element_at(F.transform(F.array(value), use), 1)


def kind_of(raw: Column) -> Column:
    """The type of a match."""
    valid = let(F.regexp_replace(raw, r"[^0-9]", ""), lambda d: _luhn(d) % 10 == 0)
    whole = lambda name: raw.rlike(f"^(?:{PATTERNS[name]})$")
    return (
        F.when(whole("email"), "email")
        .when(whole("ip"), "ip")
        .when(whole("ssn"), "ssn")
        .when(whole("access"), "access")
        .when(raw.rlike(f"^{_TITLE}\\.? "), "name")
        .when(whole("card"), F.when(valid, "card").otherwise("none"))
        .when(whole("phone"), "phone")
        .when(whole("iban"), "iban")
        .otherwise("secret")
    )


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        double = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.coalesce(F.when((n - i) % 2 == 1, double).otherwise(d), F.lit(0))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add)


def _pick(digest: Column, i: Column | int, n: int | Column) -> Column:
    """A number below n from the i-th pair of hexadecimal digits of a 128-digit digest."""
    at = (F.lit(i) if isinstance(i, int) else i) % 32
    return F.conv(F.substring(digest, at * 4 + 1, F.lit(4)), 16, 10).cast("int") % n


def _digest(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string")), 512)


def _hashed(kind: Column) -> Column:
    """A given name keeps its root whether or not a title tells the gender."""
    return F.when(kind.startswith("given"), "given").otherwise(kind)


def _letter(digest: Column, i: Column, alphabet: str) -> Column:
    return F.substring(F.lit(alphabet), _pick(digest, i, len(alphabet)) + 1, F.lit(1))


def _longer(digest: Column, more: Column, alphabet: Column) -> Column:
    """What ``more`` moves add to a surrogate."""
    letter = lambda d, i: F.substring(alphabet, _pick(d, i, F.length(alphabet)) + 1, F.lit(1))
    added = lambda d: F.array_join(F.transform(F.sequence(F.lit(1), more), lambda i: letter(d, i)), "")
    return F.when(more > 0, let(F.sha2(digest, 512), added)).otherwise("")


def _masked(canon: Column, digest: Column, hexadecimal: Column | None = None) -> Column:
    """Every letter and digit replaced by another of its class."""
    low = F.lit(False) if hexadecimal is None else hexadecimal

    def other(c: Column, i: Column) -> Column:
        return (
            F.when(c.between("0", "9"), _letter(digest, i, "0123456789"))
            .when(low & c.between("a", "f"), _letter(digest, i, "abcdef"))
            .when(low & c.between("A", "F"), _letter(digest, i, "ABCDEF"))
            .when(c.between("a", "z"), _letter(digest, i, "abcdefghijklmnopqrstuvwxyz"))
            .when(c.between("A", "Z"), _letter(digest, i, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(canon, ""), other), "")


def _numbers(canon: Column, digest: Column, first: Column) -> Column:
    """Other digits from the position ``first`` on; the first of them is not 0."""
    n = F.length(canon) - first + 1
    new = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
        lambda i: F.when(i == 0, _letter(digest, i, "123456789")).otherwise(_letter(digest, i, "0123456789")),
    )
    return F.concat(F.substring(canon, F.lit(1), first - 1), F.array_join(new, ""))


def _card(canon: Column, digest: Column, added: Column) -> Column:
    body = F.concat(_numbers(F.substring(canon, F.lit(1), F.length(canon) - 1), digest, F.lit(2)), added)
    checked = lambda b: F.concat(b, ((10 - let(F.concat(b, F.lit("0")), _luhn) % 10) % 10).cast("string"))
    return let(body, checked)


def _ip(canon: Column, digest: Column) -> Column:
    def octet(o: Column, i: Column) -> Column:
        return (
            F.when(F.length(o) == 1, 1 + _pick(digest, i, 9))
            .when(F.length(o) == 2, 10 + _pick(digest, i, 90))
            .otherwise(100 + _pick(digest, i, 155))
        ).cast("string")

    return F.array_join(F.transform(F.split(canon, r"\."), octet), ".")


def _name(kind: Column, canon: Column, digest: Column, alphabet: Column, added: Column) -> Column:
    """canon is one name part in lower case; kind tells its role. Scripts without made names get other letters of
    their own, and letters of no known alphabet a Latin name."""
    out = latin = None
    for script, (roots, male, female, ends) in PARTS.items():
        some = lambda words, i: F.element_at(F.split(F.lit(" ".join(words)), " "), _pick(digest, i, len(words)) + 1)
        end = F.when(kind == "given male", some(male, 3)).when(kind == "given female", some(female, 3)).when(kind == "surname", some(ends, 3)).otherwise(some(male + female, 3))
        third = F.when(_pick(digest, 5, 2) == 0, some(roots, 2)).otherwise("")
        made = F.initcap(F.concat(some(roots, 0), some(roots, 1), third, added, end))
        latin = made if latin is None else latin
        block = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}[script]
        out = F.when(canon.rlike(block), made) if out is None else out.when(canon.rlike(block), made)
    letter = lambda i: F.substring(alphabet, _pick(digest, i, F.length(alphabet)) + 1, F.lit(1))
    other = F.transform(F.split(canon, ""), lambda c, i: F.when(F.contains(alphabet, c), letter(i)).otherwise(c))
    out = out.when(canon.rlike(_OTHER), F.initcap(F.concat(F.array_join(other, ""), added)))
    return out.otherwise(latin)


def canonical(kind: Column, raw: Column) -> Column:
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(raw, r"[^0-9+]", ""))
        .when(kind == "email", F.lower(raw))
        .when(kind == "iban", F.replace(raw, F.lit(" "), F.lit("")))
        .otherwise(raw)
    )


def _domain(domain: Column, key: str) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 512)
    top = F.substring_index(domain, ".", -1)
    hosts = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    return F.concat(let(digest, lambda d: _masked(hosts, d)), top)


def core(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical form."""
    more = F.greatest(attempt - PLAIN_ATTEMPTS, F.lit(0))
    bound = F.struct(kind.alias("kind"), canon.alias("canon"), _digest(_hashed(kind), canon, attempt, key).alias("digest"), _alphabet(kind, canon).alias("alphabet"), more.alias("more"))
    added = lambda b: F.struct(*[b[c].alias(c) for c in ("kind", "canon", "digest", "alphabet")], _longer(b["digest"], b["more"], b["alphabet"]).alias("added"))
    return let(let(bound, added), lambda b: _core(b["kind"], b["canon"], b["digest"], b["alphabet"], b["added"], key))


def _alphabet(kind: Column, canon: Column) -> Column:
    """The letters or digits that make a surrogate longer."""
    name = F.when(canon.rlike(r"\p{IsLatin}"), LATIN).when(canon.rlike(r"\p{IsCyrillic}"), CYRILLIC).when(canon.rlike(r"\p{IsGreek}"), GREEK)
    for letters in ALPHABETS:
        name = name.when(canon.rlike(f"[{letters}]"), letters)
    return (
        F.when(kind.isin("given male", "given female", "given", "surname"), name.otherwise(LATIN))
        .when((kind == "email") | ((kind == "secret") & ~canon.rlike(_HEXADECIMAL)), LATIN)
        .when(kind == "access", LATIN.upper())
        .otherwise("0123456789")
    )


def _core(kind: Column, canon: Column, digest: Column, alphabet: Column, added: Column, key: str) -> Column:
    calling = F.when(~canon.startswith("+"), 1).when(canon.rlike(r"^\+[17]"), 3).otherwise(4)
    return (
        F.when(kind == "email", F.concat(_masked(F.substring_index(canon, "@", 1), digest), added, F.lit("@"), let(F.substring_index(canon, "@", -1), lambda d: _domain(d, key))))
        .when(kind == "phone", F.concat(_numbers(canon, digest, calling), added))
        .when(kind == "card", _card(canon, digest, added))
        .when(kind == "ip", F.concat(_ip(canon, digest), F.when(added != "", F.concat(F.lit("."), added)).otherwise("")))
        .when(kind == "ssn", F.concat(_numbers(canon, digest, F.lit(1)), added))
        .when(kind == "access", F.concat(F.substring(canon, 1, 4), _masked(F.substring(canon, F.lit(5), F.length(canon)), digest), added))
        .when(kind == "iban", F.concat(F.substring(canon, 1, 2), _masked(F.substring(canon, F.lit(3), F.length(canon)), digest), added))
        .when(kind == "secret", F.concat(_masked(canon, digest, canon.rlike(_HEXADECIMAL)), added))
        .when(kind.isin("given male", "given female", "given", "surname"), _name(kind, canon, digest, alphabet, added))
        .otherwise(canon)
    )


def _parts(raw: Column) -> tuple[Column, Column, Column]:
    """(title with its blanks, given name or empty, surname) of a name match."""
    rest = F.regexp_replace(raw, f"^{_TITLE}\\.? ", "")
    title = F.substring(raw, F.lit(1), F.length(raw) - F.length(rest))
    two = rest.contains(" ")
    return title, F.when(two, F.substring_index(rest, " ", 1)).otherwise(""), F.when(two, F.substring_index(rest, " ", -1)).otherwise(rest)


def _role(raw: Column) -> Column:
    said = lambda titles: raw.rlike("^(?:" + "|".join(titles) + r")\.? ")
    return F.when(said(MALE), "given male").when(said(FEMALE), "given female").otherwise("given")


def entities_in(raw: Column) -> Column:
    """Array of (kind, canon): one for most matches, one per part for names, none for what is left alone."""
    return let(kind_of(raw), lambda kind: _entities(kind, raw))


def _entities(kind: Column, raw: Column) -> Column:
    _, given, surname = _parts(raw)
    one = lambda k, c: F.struct(k.alias("kind"), c.alias("canon"))
    name = F.filter(F.array(one(_role(raw), F.lower(given)), one(F.lit("surname"), F.lower(surname))), lambda e: e["canon"] != "")
    return F.when(kind == "name", name).when(kind == "none", F.filter(name, lambda e: F.lit(False))).otherwise(F.array(one(kind, canonical(kind, raw))))


def replacement(raw: Column, moved: Column, key: str) -> Column:
    """The surrogate of a match in the form of the match; ``moved``: map of "kind|canon" -> attempt."""

    def core_of(kind: Column, canon: Column) -> Column:
        bound = F.struct(kind.alias("kind"), canon.alias("canon"))
        tried = lambda b: F.coalesce(F.element_at(moved, F.concat_ws("|", b["kind"], b["canon"])), F.lit(0))
        return let(bound, lambda b: core(b["kind"], b["canon"], tried(b), key))

    def named() -> Column:
        title, given, surname = _parts(raw)
        first = F.when(given != "", F.concat(core_of(_role(raw), F.lower(given)), F.lit(" "))).otherwise("")
        return F.concat(title, first, core_of(F.lit("surname"), F.lower(surname)))

    def in_form(new: Column) -> Column:
        def written(c: Column, i: Column) -> Column:
            place = F.length(F.regexp_replace(F.substring(raw, F.lit(1), i + 1), "[^0-9]", ""))
            return F.when(c.between("0", "9"), F.substring(F.regexp_replace(new, "[^0-9]", ""), place, F.lit(1))).otherwise(c)

        places = F.length(F.regexp_replace(raw, "[^0-9]", ""))
        longer = F.substring(F.regexp_replace(new, "[^0-9]", ""), places + 1, F.length(new))
        return F.concat(F.array_join(F.transform(F.split(raw, ""), written), ""), longer)

    def shown(kind: Column, new: Column) -> Column:
        spaced = F.when(raw.contains(" "), F.rtrim(F.regexp_replace(new, "(.{4})", "$1 "))).otherwise(new)
        return (
            F.when(kind.isin("phone", "card", "ssn"), in_form(new))
            .when(kind == "iban", spaced)
            .when((kind == "email") & (raw == F.upper(raw)), F.upper(new))
            .otherwise(new)
        )

    plain = lambda kind: let(core_of(kind, canonical(kind, raw)), lambda new: shown(kind, new))
    return let(kind_of(raw), lambda kind: F.when(kind == "none", raw).when(kind == "name", named()).otherwise(plain(kind)))


def moved_entities(found: DataFrame, key: str) -> DataFrame:
    """kind, canon, attempt of the entities whose first surrogate clashes. ``found``: distinct kind, canon."""
    current = materialise(found.withColumn("attempt", F.lit(0)).withColumn("core", core(F.col("kind"), F.col("canon"), F.lit(0), key)), "entities")
    first = Window.partitionBy("kind", "core").orderBy("canon")
    again = core(F.col("kind"), F.col("canon"), F.col("attempt"), key)  # built once: a long expression
    while True:
        real = current.select("kind", F.col("canon").alias("core"), F.lit(True).alias("real"))
        # an e-mail's and a name's surrogate is compared in the form of the canon
        held = current.withColumn("same", F.row_number().over(first)).withColumn("shown", F.lower("core"))
        checked = held.join(real.select("kind", F.lower("core").alias("shown"), "real").distinct(), ["kind", "shown"], "left")
        clash = (F.col("same") > 1) | F.coalesce(F.col("real"), F.lit(False))
        # one column per step: inside of a select's lambda "attempt" could mean the new or the old one
        moved = checked.withColumn("clash", clash).withColumn("attempt", F.col("attempt") + F.col("clash").cast("int"))
        moved = moved.withColumn("core", F.when(F.col("clash"), again).otherwise(F.col("core"))).select("kind", "canon", "attempt", "core", "clash")
        moved = materialise(moved, "entities")
        current = moved.drop("clash")
        if not moved.filter("clash").limit(1).count():
            return current.filter("attempt > 0").select("kind", "canon", "attempt")


def replace_entities(docs: DataFrame, keep: Sequence[str], key_column: str = "doc_id", text: str = "text", key: str = KEY) -> DataFrame:
    """row (struct of ``keep``), clean (the text with surrogates), entities (matches replaced)."""
    t = F.col(f"`{text}`")
    name = F.concat_ws("|", F.col(f"`{key_column}`").cast("string"), F.xxhash64(t).cast("string"))
    held = docs.filter(may_hold(t)).select(name.alias("name"), F.regexp_extract_all(t, F.lit(ENTITY), 0).alias("m"))
    listed = held.select("name", F.explode("m").alias("raw")).select("name", F.explode(entities_in(F.col("raw"))).alias("e"))
    listed = materialise(listed.select("name", "e.kind", "e.canon").distinct(), "entities")
    moved = moved_entities(listed.select("kind", "canon").distinct(), key)
    tries = (
        listed.join(moved, ["kind", "canon"])
        .groupBy("name")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "canon"), "attempt"))).alias("moved"))
    )
    tries = materialise(tries, "moved")
    if tries.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        tries = F.broadcast(tries)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), t.alias("t"), name.alias("name"))
    joined = rows.join(tries, "name", "left").withColumn("moved", F.coalesce("moved", F.create_map().cast("map<string,int>")))
    # one column per step: each is used more than once and must not be computed again
    found = F.when(may_hold(F.col("t")), F.regexp_extract_all("t", F.lit(ENTITY), 0)).otherwise(F.array().cast("array<string>"))
    split = joined.withColumn("found", found).withColumn("gaps", F.when(F.size("found") > 0, F.split("t", ENTITY, -1)))
    new = F.transform("found", lambda raw: replacement(raw, F.col("moved"), key))
    mended = F.array_join(F.flatten(F.zip_with("gaps", new, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    return split.select(
        "row",
        F.when(F.size("found") > 0, mended).otherwise(F.col("t")).alias("clean"),
        F.size(F.filter("found", lambda r: kind_of(r) != "none")).cast("long").alias("entities"),
    )


def without_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs``, with surrogates in the text."""
    clean = replace_entities(docs, docs.columns, text=text)
    return clean.select(*[(F.col("clean") if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])


@query("op6_pii_surrogates")
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = replace_entities(table(spark, sf_dir, "documents"), ["doc_id"])
    return clean.select("row.doc_id", F.col("clean").alias("text"), "entities")
