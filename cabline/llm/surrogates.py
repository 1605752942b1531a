"""PII: keyed, type-consistent surrogates for detected entities, in DataFrame functions only.

Entities: e-mail, IPv4 and IPv6 addresses, phone, card (also 4-6-5) and social-security
numbers, IBANs, access keys, assigned secrets (password, token, ..., also under a quoted
key, of any length, up to white space or a quote) and names: up to four words after a
title, two after a known given name.  Not found: names with neither (``Wei Zhang``), bare
surnames, addresses, phone numbers without separators, secrets that nothing assigns.  Every entity has a canonical form (lower-cased
address, digits of a number, the name without its title); its surrogate is a
function of key, type, canonical form and an attempt number, so all mentions in
all documents, in any notation, get the same one (coreference).

Type and format stay: digits become digits, letters letters of their case,
separators stay; numbers that pass the Luhn check still do; IPs lie in
240.0.0.0/4 (IPv6: fd00::/8) and e-mail domains end in .example, which nobody holds; given names
come from the list of the same gender and script, surnames are built of
syllables of the script, with the feminine ending where the script has one;
titles stay.

Collision check, over all distinct entities of the input: a surrogate that two
entities share (the smaller canonical form keeps it), or that is itself an
entity of the input, is drawn again with the next attempt; attempts of
free-form types are one sign longer each, and those of fixed formats thin out from round to
round, so that the rounds end unless a type has more entities than its format has
values (an error).  Entities that needed another attempt go to the texts by a join on the
texts' hashes; as a rule there are none, and replacing then shuffles nothing.

Cases: a null text stays null, one without entities is returned as it is; a
null id and repeated rows are handled alike; an empty table gives no rows;
other columns are passed on whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import cut

MAX_ATTEMPTS = 64
#: overrides up to this many are broadcast; beyond it they are joined
BROADCAST_OVERRIDES = 10_000

# Given names and syllables by script, titles by gender.
NAMES = {
    "male": ("Albert", "Andreas", "Anthony", "Antonio", "Benjamin", "Carlos", "Charles",
             "Christian", "Daniel", "Edward", "Fernando", "Francisco", "Friedrich", "George",
             "Hans", "Heinrich", "Henry", "Jacques", "James", "John", "Joseph", "Jürgen", "Louis",
             "Manuel", "Michael", "Miguel", "Nicolas", "Patrick", "Paul", "Peter", "Philippe",
             "Pierre", "Richard", "Robert", "Stephen", "Thomas", "Walter", "William", "Wolfgang"),
    "female": ("Alexandra", "Angela", "Barbara", "Carmen", "Catherine", "Charlotte", "Christine",
               "Claudia", "Dorothy", "Elizabeth", "Emily", "Florence", "Françoise", "Gabriele",
               "Gertrud", "Helen", "Isabelle", "Jennifer", "Jessica", "Katharina", "Laura",
               "Linda", "Lucía", "Margaret", "Maria", "Martha", "Mary", "Monika", "Nathalie",
               "Patricia", "Sabine", "Sarah", "Sophie", "Susan", "Teresa", "Ursula", "Victoria"),
    "cyrillic male": ("Александр", "Алексей", "Андрей", "Владимир", "Дмитрий", "Иван", "Михаил",
                      "Николай", "Павел", "Сергей"),
    "cyrillic female": ("Александра", "Анна", "Елена", "Екатерина", "Ирина", "Мария", "Наталья",
                        "Ольга", "Светлана", "Татьяна"),
}
TITLES = {"male": ("Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor"),
          "female": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora"),
          "cyrillic male": ("господин",), "cyrillic female": ("госпожа",),
          # of either gender: the given name decides
          "any": ("Dr", "Prof", "Professor", "Doctor", "Doktor", "Docteur")}
SYLLABLES = {"latin": ("bar", "cor", "dan", "fer", "gal", "hen", "jor", "kel", "lan", "mar", "nor",
                       "pel", "ros", "sil", "tam", "ver"),
             "cyrillic": ("бар", "кор", "дан", "фер", "гал", "лен", "зор", "кел", "лан", "мар",
                          "нор", "пел", "рос", "сил", "там", "вер")}

_DIGIT_WORDS = {
    "card": r"(?<![\d+])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?!\d)"
            r"|(?<![\d+])3\d{3}([ -]?)\d{6}\1\d{5}(?!\d)",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
             r"|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
             r"|(?<![\d-])(?<!\d )\d{3} \d{3} \d{4}(?![\d-])(?! \d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
}
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
_NAME = r"\p{Lu}[\p{Ll}'’]+(?:-\p{Lu}\p{Ll}+)?"
_ALL_TITLES = "|".join(t for titles in TITLES.values() for t in titles)
_GIVEN = "|".join(n for names in NAMES.values() for n in names)
PATTERNS = {
    "secret": r"(?=[pPtTsSaA])(?i:password|passwd|pwd|token|secret|api[_-]?key)[\"']?"
              r"\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{6,}+",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}"
             r"[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
            r"(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "ipv6": rf"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]{{0,39}}\d)(?:(?:{_HEX}:){{7}}{_HEX}"
            rf"|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![0-9A-Za-z:])",
    "card": _DIGIT_WORDS["card"].replace(r"([ -]?)", "[ -]?").replace(r"\1", "[ -]?"),
    "ssn": _DIGIT_WORDS["ssn"],
    "phone": _DIGIT_WORDS["phone"],
    "person": rf"(?<!\p{{L}})(?=[\p{{Lu}}г])(?:(?:{_ALL_TITLES})\.? (?:{_NAME} ){{0,3}}{_NAME}"
              rf"|(?:{_GIVEN})(?: {_NAME}){{1,2}})(?!\p{{L}})",
}
ANY = "|".join(PATTERNS.values())
_SIGNED = "|".join(p for k, p in PATTERNS.items() if k != "person")
#: no entity but a name is without a match of this: one cheap look per sign
HINT = "[@0-9=:]|A[KS]IA"

_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (a one-element transform)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _nth(text: Column, n: Column) -> Column:
    """Sign number ``n`` (from 0) of a text."""
    return F.substr(text, n.cast("int") + 1, F.lit(1))


def _draw(digest: Column, i: Column, size: int) -> Column:
    """A number under ``size`` from hex digits of a 64-digit digest (position ``i``)."""
    return F.pmod(F.conv(F.substr(digest, F.pmod(3 * i, F.lit(60)).cast("int") + 1, F.lit(5)),
                         16, 10).cast("long"), F.lit(size))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def entity_type(mention: Column) -> Column:
    kind = None
    for name, pattern in PATTERNS.items():
        fits = mention.rlike(f"^(?:{pattern})$")
        kind = F.when(fits, F.lit(name)) if kind is None else kind.when(fits, F.lit(name))
    return kind


def _prefix(kind: Column, mention: Column) -> Column:
    """What stands before the entity inside the mention: a secret's name, a title."""
    secret = (r"^((?i:password|passwd|pwd|token|secret|api[_-]?key)[\"']?"
              r"\s{0,3}[=:]\s{0,3}[\"']?)")
    return (F.when(kind == "secret", F.regexp_extract(mention, secret, 1))
            .when(kind == "person", F.regexp_extract(mention, rf"^((?:{_ALL_TITLES})\.? )", 1))
            .otherwise(F.lit("")))


def canonical(kind: Column, mention: Column, prefix: Column) -> Column:
    body = F.substr(mention, F.length(prefix) + 1)
    return (F.when(kind.isin("email", "ipv6"), F.lower(body))
            .when(kind.isin("phone", "card", "ssn"), _digits(body))
            .when(kind == "iban", F.replace(body, F.lit(" "), F.lit("")))
            .otherwise(body))


def _shaped(value: Column, digest: Column) -> Column:
    """Each digit and Latin letter turned into another, its kind and place kept."""
    def sign(s: Column, c: Column, i: Column) -> Column:
        def turned(signs: str, part: Column) -> Column:
            n = F.instr(F.lit(signs), c) - 1
            return _nth(F.lit(signs), F.pmod(n + 1 + _draw(part, i, len(signs) - 1),
                                             F.lit(len(signs))))

        part = F.sha2(F.concat(s["d"], (i / 20).cast("int").cast("string")), 256)
        return _let(part, lambda part: F.when(c.rlike("[0-9]"), turned("0123456789", part))
                    .when(s["h"] & c.rlike("[a-f]"), turned("abcdef", part))
                    .when(c.rlike("[a-z]"), turned(_LOWER, part))
                    .when(c.rlike("[A-Z]"), turned(_UPPER, part)).otherwise(c))

    bound = F.struct(value.alias("v"), digest.alias("d"),
                     value.rlike("^(?=.*[0-9])[0-9a-f]{8,}$|^[0-9a-f:]*:[0-9a-f:]*$").alias("h"))
    return _let(bound, lambda s: F.array_join(F.transform(
        F.split(s["v"], ""), lambda c, i: sign(s, c, i)), ""))


def _luhn(digits: Column, odd: bool) -> Column:
    """The Luhn sum; ``odd``: the last digit is doubled (it awaits its check digit)."""
    signs = F.split(F.reverse(digits), "")

    def part(c: Column, i: Column) -> Column:
        d = F.coalesce(c.cast("int"), F.lit(0))
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(F.pmod(i, F.lit(2)) == (0 if odd else 1), twice).otherwise(d)

    return F.aggregate(F.transform(signs, part), F.lit(0), lambda a, x: a + x)


def _number(kind: Column, digits: Column, digest: Column) -> Column:
    """New digits: the first of a card and the first two of a phone stay; Luhn kept."""
    keep = F.when(kind == "card", 1).when(kind == "phone", 2).otherwise(0)

    def checked(new: Column) -> Column:
        stem = F.substr(new, F.lit(1), F.length(new) - 1)
        check = F.pmod(10 - F.pmod(_luhn(stem, True), F.lit(10)), F.lit(10))
        valid = (kind == "card") & (F.pmod(_luhn(digits, False), F.lit(10)) == 0)
        return F.when(valid, F.concat(stem, check.cast("string"))).otherwise(new)

    return _let(F.concat(F.substr(digits, F.lit(1), keep),
                         _shaped(F.substr(digits, keep + 1), digest)), checked)


def _built_surname(surname: Column, attempt: Column, digest) -> Column:
    cyrillic = surname.rlike(r"^\p{IsCyrillic}")

    def syllables(script: str, seed: Column) -> list[Column]:
        table = F.array(*map(F.lit, SYLLABLES[script]))
        return [F.get(table, _draw(seed, F.lit(i), len(SYLLABLES[script])).cast("int"))
                for i in range(4)]

    def built(seed: Column) -> Column:
        more = F.repeat(F.substr(F.translate(seed, "0123456789", "aeiouaeiou"), F.lit(50),
                                 F.lit(2)), attempt.cast("int"))
        ending = F.when(surname.rlike("[ая]$"), F.lit("ова")).otherwise(F.lit("ов"))
        return F.initcap(F.when(cyrillic, F.concat(
            *syllables("cyrillic", seed), F.repeat(F.lit("ан"), attempt.cast("int")), ending))
            .otherwise(F.concat(*syllables("latin", seed), more)))

    return _let(digest(F.concat(F.lit("surname|"), surname, F.lit("|"), attempt.cast("string"))),
                built)


def _listed_given(given: Column, surname: Column, title: Column, digest) -> Column:
    """A given name of the gender and script that name, title or surname show."""
    group = None
    for k in ("female", "male", "cyrillic female", "cyrillic male"):
        fits = given.isin(*NAMES[k])
        group = F.when(fits, F.lit(k)) if group is None else group.when(fits, F.lit(k))
    for k in ("male", "female", "cyrillic male", "cyrillic female"):
        titles = TITLES[k]
        group = group.when(F.replace(title, F.lit("."), F.lit("")).isin(*titles), F.lit(k))
    group = (group.when(surname.rlike(r"^\p{IsCyrillic}.*[ая]$"), F.lit("cyrillic female"))
             .when(surname.rlike(r"^\p{IsCyrillic}"), F.lit("cyrillic male"))
             .otherwise(F.lit("male")))
    lists = F.create_map(*[x for k, names in NAMES.items()
                           for x in (F.lit(k), F.array(*map(F.lit, names)))])
    return _let(F.element_at(lists, group), lambda names: F.get(names, F.pmod(
        F.conv(F.substr(digest(F.concat(F.lit("given|"), given)), F.lit(1), F.lit(8)), 16, 10)
        .cast("long"), F.size(names)).cast("int")))


def _person(body: Column, title: Column, digest, attempt: Column) -> Column:
    """``[given [middle ]]surname``: the given name is listed, the others built of syllables."""
    def named(parts: Column) -> Column:
        surname = F.element_at(parts, -1)
        first = F.when(F.size(parts) > 1, 2).otherwise(1)
        built = F.transform(F.slice(parts, first, F.size(parts)),
                            lambda name: _built_surname(name, attempt, digest))
        built = F.array_join(built, " ")
        return F.when(F.size(parts) > 1, F.concat(
            _listed_given(F.element_at(parts, 1), surname, title, digest), F.lit(" "), built)
        ).otherwise(built)

    return _let(F.split(body, " "), named)


def surrogate(kind: Column, canon: Column, title: Column, attempt: Column, key: str) -> Column:
    """The surrogate's canonical form."""
    def digest(what: Column) -> Column:
        return F.sha2(F.concat(F.lit(key + "|"), kind, F.lit("|"), what), 256)

    def email(seed: Column, longer: Column) -> Column:
        domain = F.substr(canon, F.instr(canon, "@") + 1)
        name = F.substr(domain, F.lit(1), F.length(domain) - 1
                        - F.length(F.substring_index(domain, ".", -1)))
        return F.concat(_shaped(F.substr(canon, F.lit(1), F.instr(canon, "@") - 1), seed), longer,
                        F.lit("@"), _let(name, lambda name: _shaped(
                            name, digest(F.concat(F.lit("domain|"), name)))), F.lit(".example"))

    def drawn(seed: Column) -> Column:
        longer = F.substr(F.translate(seed, "0123456789", "ghijklmnop"), F.lit(30),
                          attempt.cast("int"))
        head = F.when(kind == "iban", 2).otherwise(4)
        ip = F.concat_ws(".", (240 + _draw(seed, F.lit(0), 15)).cast("string"),
                         *[_draw(seed, F.lit(i), 256).cast("string") for i in (1, 2, 3)])
        # a first group of four digits starts with fd: addresses for local use
        ipv6 = _let(_shaped(canon, seed), lambda new: F.when(
            canon.rlike("^[0-9a-f]{4}:"), F.concat(F.lit("fd"), F.substr(new, F.lit(3))))
            .otherwise(new))
        return (F.when(kind == "email", email(seed, longer)).when(kind == "ip", ip)
                .when(kind == "ipv6", ipv6)
                .when(kind.isin("phone", "card", "ssn"), _number(kind, canon, seed))
                .when(kind.isin("iban", "key"), F.concat(
                    F.substr(canon, F.lit(1), head), _shaped(F.substr(canon, head + 1), seed)))
                .when(kind == "secret", F.concat(_shaped(canon, seed), longer))
                .when(kind == "person", _person(canon, title, digest, attempt)))

    return _let(digest(F.concat(attempt.cast("string"), F.lit("|"), canon)), drawn)


def _rendered(kind: Column, mention: Column, prefix: Column, new: Column) -> Column:
    """The surrogate in the mention's notation."""
    def refill(s: Column) -> Column:
        wanted = F.when(s["k"] == "iban", F.lit("[0-9A-Z]")).otherwise(F.lit("[0-9]"))

        def sign(c: Column, i: Column) -> Column:
            before = F.substr(s["b"], F.lit(1), i)
            return F.when(F.rlike(c, wanted), _nth(s["n"], F.length(
                F.regexp_replace(before, F.when(s["k"] == "iban", F.lit("[^0-9A-Z]"))
                                 .otherwise(F.lit("[^0-9]")), F.lit(""))))).otherwise(c)

        return F.array_join(F.transform(F.split(s["b"], ""), sign), "")

    body = F.substr(mention, F.length(prefix) + 1)
    bound = F.struct(kind.alias("k"), body.alias("b"), new.alias("n"))
    return F.concat(prefix, F.when(kind.isin("phone", "card", "ssn", "iban"), _let(bound, refill))
                    .otherwise(new))


def _mentions(text: Column) -> Column:
    """The mentions in a text, in order; most texts are searched for names alone."""
    def found(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)

    named = text.rlike(PATTERNS["person"])
    return (F.when(text.rlike(HINT), F.when(named, found(ANY)).otherwise(found(_SIGNED)))
            .when(named, found(PATTERNS["person"])).otherwise(F.array().cast("array<string>")))


def _entity(mention: Column) -> Column:
    """struct(mention, kind, prefix, canon, title)."""
    typed = F.struct(mention.alias("mention"), entity_type(mention).alias("kind"))
    cut_at = _let(typed, lambda s: F.struct(
        s["mention"], s["kind"], _prefix(s["kind"], s["mention"]).alias("prefix")))
    return _let(cut_at, lambda s: F.struct(
        s["mention"], s["kind"], s["prefix"],
        canonical(s["kind"], s["mention"], s["prefix"]).alias("canon"),
        F.when(s["kind"] == "person", F.trim(s["prefix"])).otherwise(F.lit("")).alias("title")))


def resolve(entities: DataFrame, key: str) -> DataFrame | None:
    """(kind, canon, attempt) of the distinct ``entities(kind, canon, title)`` whose
    first surrogate collides; None if there are none."""
    # a name's title chooses the given name; of several the smallest counts
    entities = entities.groupBy("kind", "canon").agg(F.min("title").alias("title"))
    state = cut(entities.withColumn("attempt", F.lit(0)), "surrogates")
    changed = False
    for _ in range(MAX_ATTEMPTS):
        drawn = state.withColumn("new", surrogate(F.col("kind"), F.col("canon"), F.col("title"),
                                                  F.col("attempt"), key))
        shared = (drawn.groupBy("kind", "new").agg(F.min("canon").alias("first"),
                                                   F.count("*").alias("n"))
                  .where("n > 1").drop("n"))
        real = drawn.select("kind", F.col("canon").alias("new")).withColumn("real", F.lit(True))
        lost = (drawn.join(shared, ["kind", "new"], "left").join(real, ["kind", "new"], "left")
                .withColumn("lost", (F.coalesce(F.col("canon") != F.col("first"), F.lit(False))
                                     | F.col("real").isNotNull())))
        lost = cut(lost.select("kind", "canon", "title",
                               (F.col("attempt") + F.col("lost").cast("int")).alias("attempt"),
                               "lost"), "surrogates")
        if not lost.where("lost").limit(1).count():
            return state.where("attempt > 0").drop("title") if changed else None
        changed, state = True, lost.drop("lost")
    raise RuntimeError("surrogates still collide: a type's format has too few values")


def replace_pii(df: DataFrame, key: str, text_col: str = "text",
                count_col: str | None = None) -> DataFrame:
    """``df`` with surrogates in ``text_col``; ``count_col``: adds the number of mentions."""
    text = F.col(text_col)
    found = df.select(F.explode(_mentions(text)).alias("mention"))
    # equal mentions are combined before their types are looked up
    entities = (found.groupBy("mention").agg(F.lit(1).alias("one"))
                .select(_entity(F.col("mention")).alias("e"))
                .select("e.kind", "e.canon", "e.title"))
    overrides = resolve(entities, key)
    columns, marks = df.columns, "__mentions"
    df = df.withColumn(marks, _mentions(text))

    def replaced(attempt) -> Column:
        def new(mention: Column) -> Column:
            return _let(_entity(mention), lambda e: _rendered(
                e["kind"], e["mention"], e["prefix"],
                surrogate(e["kind"], e["canon"], e["title"], attempt(e["kind"], e["canon"]), key)))

        # the text between the mentions, and the mentions' surrogates
        between = F.split(text, ANY, -1)
        both = F.zip_with(between, F.transform(F.col(marks), new),
                          lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        return F.when(F.size(marks) > 0, F.array_join(both, "")).otherwise(text)

    if overrides is None:
        out = df.withColumn(text_col, replaced(lambda kind, canon: F.lit(0)))
    else:
        few = overrides.count() <= BROADCAST_OVERRIDES
        hold = F.broadcast if few else (lambda x: x)
        # equal texts have equal mentions: keyed by the text, whatever its id
        df = df.withColumns({"__h": F.xxhash64(text), "__g": F.hash(text)})
        of_text = (df.where(F.size(marks) > 0).select("__h", "__g", F.explode(marks).alias("mention"))
                   .distinct().withColumn("e", _entity(F.col("mention")))
                   .select("__h", "__g", F.col("e.kind").alias("kind"), F.col("e.canon").alias("canon"))
                   .join(hold(overrides), ["kind", "canon"])
                   .groupBy("__h", "__g").agg(F.map_from_entries(F.collect_set(F.struct(
                       F.concat_ws("|", "kind", "canon"), "attempt"))).alias("__attempts")))
        df = df.join(of_text, ["__h", "__g"], "left")
        out = df.withColumn(text_col, replaced(lambda kind, canon: F.coalesce(
            F.try_element_at(F.col("__attempts"), F.concat_ws("|", kind, canon)), F.lit(0))))
    counted = [F.size(marks).cast("long").alias(count_col)] if count_col else []
    return out.select(*columns, *counted)
