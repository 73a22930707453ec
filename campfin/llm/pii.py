"""PII surrogates (operator 2).

Entities are found by one expression of kinds (e-mail, IP address, card,
phone, social security number, IBAN, names after a gendered title).  Each
distinct entity, in its normal form, gets one surrogate of its kind, made from
a keyed hash: digits become digits and letters letters of the same script, a
phone keeps its country code, a card its first digit and whether its checksum
holds, an e-mail ends in a reserved domain, a name keeps script and gender.
Written in another format the entity gets the same surrogate in that format.
A titled name's other mentions in the same text, without title, follow it.

Distinctness is checked over the whole corpus: a surrogate that another entity
has taken, or that is itself an entity of the corpus, is drawn again (with one
more character after every eighth draw).  What is joined is the table of
distinct entities; texts without entities are never shuffled.  All of it is
DataFrame expressions.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, functions as F

from campfin.llm.components import stored

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d{1,2})"
_MALE = r"Mr|Mister|Herr|Herrn|Señor|Sr|Don|Monsieur|(?<!\p{Lu}\.\x20)M(?=\.)|господин"
_FEMALE = "Mrs|Ms|Miss|Frau|Señora|Señorita|Sra|Srta|Doña|Madame|Mme|Mlle|госпожа"
#: A text with a name has one of these (the titles' beginnings), with any other
#: entity an at sign or a digit.  Literal tests, before any pattern runs.
_LITERALS = ("@", "Mr", "Mister", "Ms", "Miss", "Herr", "Frau", "Señor", "Sr", "Don", "Doña", "Monsieur", "M.",
             "Madame", "Mme", "Mlle", "господин", "госпожа")
#: Ordinary words that are also names (fixed values): without title they follow
#: a name only inside a clause or beside another name of the text.
_ORDINARY = ("art bell best bill black bond book brown bush carol church cook dawn drew english faith fair field "
             "fish forest frank french good grace grant gray green hall hand hill hope hunt jack joy june king law "
             "lee little long love mark marsh may miles miller moon moore mount noble north page park pat penny pope "
             "price ray read rich rock rose sandy short smart snow south spring star stone strong sunny sweet swift "
             "victor violet wall ward waters west white will wise wolf wood woods young "
             "groß klein lang kurz schwarz weiß braun jung stark kaiser könig bauer koch sommer winter herbst morgen "
             "petit grand blanc noir roux rose pierre fontaine dubois leblanc legrand marin "
             "blanco rojo moreno bueno bello ángel rey santos cruz paz sol luz")
#: Names between a title and the last name found (a lookbehind is bounded).
BEFORE = 6
_NOT_IN_WORD, _WORD_ENDS = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"


def _named(titles: str) -> str:
    """A capitalised word after a title, or after a title and up to
    ``BEFORE`` such words or initials; a possessive 's stays outside."""
    before = ""
    for _ in range(BEFORE):  # a lookbehind takes no repeated group
        before = rf"(?:(?:\p{{Lu}}\.|\p{{Lu}}[\p{{L}}'’-]{{0,30}})\x20{before})?"
    return (rf"(?=\p{{Lu}})(?<=(?<!\p{{L}})(?:{titles})\.?\x20{before})"
            r"(\p{Lu}(?:[\p{L}-]|['’](?!s?(?!\p{L}))){0,60}+)")


#: Kind and expression (one group each), in order of preference.
KINDS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])([\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)"),
    ("ip", rf"(?<![\p{{L}}\p{{N}}.])({_OCTET}(?:\.{_OCTET}){{3}})(?!\.?[\p{{L}}\p{{N}}])"),
    ("card", _NOT_IN_WORD + r"(\d(?:[ -]?\d){12,18})" + _WORD_ENDS),
    ("phone", r"(?<![\p{L}\p{N}+])((?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
              r"|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4})" + _WORD_ENDS),
    ("ssn", _NOT_IN_WORD + r"(\d{3}-\d{2}-\d{4})" + _WORD_ENDS),
    ("iban", _NOT_IN_WORD + r"([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)" + _WORD_ENDS),
    ("name_m", _named(_MALE)),
    ("name_f", _named(_FEMALE)),
)
PATTERN = "|".join(p for _, p in KINDS)
_PLAIN, _CYRILLIC, _GREEK = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщыэюя",
                             "αβγδεζηθικλμνξοπρστυφχψω")


def may_have(text: Column) -> Column:
    """Whether a text has anything that an entity can't do without."""
    out = F.rlike(text, F.lit("[0-9]"))
    for x in _LITERALS:
        out = out | F.contains(text, F.lit(x))
    return out


def entities(text: Column) -> Column:
    """array of (i, kind, raw) of the matches in a text, in order."""
    by_kind = [F.regexp_extract_all(text, F.lit(PATTERN), F.lit(k + 1)) for k in range(len(KINDS))]
    zipped = F.arrays_zip(*[a.alias(n) for a, (n, _) in zip(by_kind, KINDS)])

    def one(m: Column, i: Column) -> Column:
        raw, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
        for n, _ in reversed(KINDS):
            raw = F.when(m[n] != "", m[n]).otherwise(raw)
            kind = F.when(m[n] != "", F.lit(n)).otherwise(kind)
        return F.struct(i.alias("i"), kind.alias("kind"), raw.alias("raw"))

    return F.transform(zipped, one)


def normal(kind: Column, raw: Column) -> Column:
    """One form for all ways to write an entity."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    national = F.when((F.length(digits) == 11) & F.startswith(digits, F.lit("1")),
                      F.substring(digits, 2, 10)).otherwise(digits)
    abroad = F.startswith(raw, F.lit("+")) & (F.length(national) == F.length(digits))
    phone = F.when(abroad, F.concat(F.lit("+"), digits)).otherwise(national)
    return (F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), digits)
            .when(kind == "iban", F.regexp_replace(raw, " ", ""))
            .when(kind == "ip", raw).otherwise(F.lower(raw)))


#: Country codes of two digits (fixed values); 1 and 7 have one, others three.
_TWO = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 "
        "84 86 90 91 92 93 94 95 98").split()


def country_code(norm: Column) -> Column:
    """The plus sign and country code that an international number begins with."""
    n = (F.when(F.substring(norm, 2, 1).isin("1", "7"), 2).when(F.substring(norm, 2, 2).isin(*_TWO), 3).otherwise(4))
    return F.when(F.startswith(norm, F.lit("+")), F.substring(norm, F.lit(1), n)).otherwise("")


def _stream(key: str, *parts: Column) -> Column:
    """128 keyed hex digits."""
    seed = F.concat_ws("|", F.lit(key), *parts)
    return F.concat(F.sha2(F.concat(F.lit("0"), seed), 256), F.sha2(F.concat(F.lit("1"), seed), 256))


def _byte(stream: Column, i: Column) -> Column:
    at = F.pmod(i - 1, F.lit(64)) * 2 + 1
    return F.conv(F.substring(stream, at, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(n, F.lit(len(alphabet))) + 1, F.lit(1))


def _alike(s: Column, stream: Column) -> Column:
    """Digits to digits, letters to letters of the same script and case."""
    def one(i: Column) -> Column:
        c, b = F.substring(s, i, F.lit(1)), _byte(stream, i)
        letter = (F.when(F.rlike(c, F.lit(r"\p{IsCyrillic}")), _pick(_CYRILLIC, b))
                  .when(F.rlike(c, F.lit(r"\p{IsGreek}")), _pick(_GREEK, b))
                  .otherwise(_pick(_PLAIN, b)))
        return (F.when(F.rlike(c, F.lit(r"[0-9]")), F.pmod(b, F.lit(10)).cast("string"))
                .when(F.rlike(c, F.lit(r"\p{Lu}")), F.upper(letter))
                .when(F.rlike(c, F.lit(r"[\p{L}\p{N}]")), letter).otherwise(c))

    return F.when(F.length(s) > 0, F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(s)), one), "")).otherwise("")


def _luhn(digits: Column) -> Column:
    """Sum of the checksum; the last digit counts once."""
    n = F.length(digits)

    def one(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(F.pmod(n - i, F.lit(2)) == 1, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), one), F.lit(0), lambda a, b: a + b)


def surrogate(key: str, kind: Column, norm: Column, draw: int) -> Column:
    """Normal form of an entity's surrogate in one draw."""
    stream = _stream(key, kind, norm, F.lit(str(draw)))
    longer = F.lit("") if draw < 8 else _alike(F.lit("0" * (draw // 8)), F.reverse(stream))
    mapped = _alike(norm, stream)
    # e-mail: local part, mapped labels but the last two, a reserved domain
    local = F.substring_index(norm, "@", 1)
    domain = F.substring_index(norm, "@", -1)
    own = _stream(key, F.lit("domain"), domain)
    labels = F.split(domain, r"\.")
    sub = F.when(F.size(labels) > 2, F.concat(F.array_join(F.transform(
        F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))),
        lambda x: _alike(x, _stream(key, F.lit("label"), domain, x))), "."), F.lit("."))).otherwise("")
    tld = F.element_at(F.array(F.lit("com"), F.lit("net"), F.lit("org")),
                       F.pmod(_byte(own, F.lit(1)), F.lit(3)) + 1)
    email = F.concat(_alike(local, stream), longer, F.lit("@"), sub, F.lit("example."), tld)
    octets = [(F.pmod(_byte(stream, F.lit(i)), F.lit(254)) + 1).cast("string") for i in range(1, 5)]
    # card: first digit stays; last digit makes the checksum hold or fail as before
    n = F.length(norm)
    body = F.concat(F.substring(norm, 1, 1), F.substring(mapped, F.lit(2), n - 2))
    check = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    off = F.pmod(check + 1 + F.pmod(_byte(stream, F.lit(40)), F.lit(9)), F.lit(10))
    card = F.concat(body, longer, F.when(F.pmod(_luhn(norm), F.lit(10)) == 0, check).otherwise(off)
                    .cast("string"))
    if draw >= 8:
        whole = F.concat(body, longer)
        check = F.pmod(10 - F.pmod(_luhn(F.concat(whole, F.lit("0"))), F.lit(10)), F.lit(10))
        card = F.concat(whole, F.when(F.pmod(_luhn(norm), F.lit(10)) == 0, check).otherwise(
            F.pmod(check + 1, F.lit(10))).cast("string"))
    code = country_code(norm)
    phone = F.concat(code, _pick("23456789", _byte(stream, F.lit(1))),
                     F.substring(mapped, F.length(code) + 2, n), longer)
    iban = F.concat(F.substring(norm, 1, 2), F.substring(mapped, F.lit(3), n), longer)
    name = _name(norm, stream, kind == "name_f", draw)
    return (F.when(kind == "email", email).when(kind == "ip", F.concat_ws(".", *octets))
            .when(kind == "card", card).when(kind == "phone", phone).when(kind == "iban", iban)
            .when(kind.isin("name_m", "name_f"), name).otherwise(F.concat(mapped, longer)))


def _name(norm: Column, stream: Column, female: Column, draw: int) -> Column:
    """Syllables of the name's script with an ending of its gender, lower
    case, about as long."""
    n = F.least(F.greatest(F.floor(F.length(norm) / 2).cast("int") - 1, F.lit(2)), F.lit(6)) + draw // 8

    def syllables(first: str, second: str, male: str, fem: str) -> Column:
        stem = F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(
            _pick(first, _byte(stream, i)), _pick(second, _byte(stream, i + 30)))), "")
        return F.concat(stem, F.when(female, _pick(fem, _byte(stream, F.lit(60)))
                                     ).otherwise(_pick(male, _byte(stream, F.lit(60)))))

    return (F.when(F.rlike(norm, F.lit(r"\p{IsCyrillic}")), syllables("бвгдклмнрст", "аеиоу", "нрсл", "ая"))
            .when(F.rlike(norm, F.lit(r"\p{IsGreek}")), syllables("βγδκλμνπρτ", "αειου", "ς", "αη"))
            .otherwise(syllables("bdfgklmnrstv", "eiou", "nrsl", "a")))


def _name_like(raw: Column, s: Column) -> Column:
    """A name's surrogate in capitals where the name is, else capitalised."""
    return F.when((F.length(raw) > 1) & (F.upper(raw) == raw), F.upper(s)).otherwise(
        F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s))))


def bare_mentions(gaps: Column, new: Column) -> Column:
    """array of (text, n) of the texts between entities, with the capitalised
    words that are names of the same text (``new``: i, r, norm or null, s)
    replaced and counted.  A name that came after titles of both genders
    follows the last before it.  Names of one letter are left alone, and so are
    names that are ordinary words where a sentence or clause begins."""
    names = F.filter(new, lambda x: F.length(x["norm"]) > 1)
    longest_first = F.sort_array(F.array_distinct(F.transform(
        names, lambda x: F.struct((-F.length(x["norm"])).alias("l"), x["norm"].alias("norm")))))
    def any_of(x: Column) -> Column:
        return F.array_join(F.transform(x, lambda n: n["norm"]), "|")

    ordinary = F.array(*[F.lit(w) for w in sorted(set(_ORDINARY.split()))])
    words = F.filter(longest_first, lambda x: F.array_contains(ordinary, x["norm"]))
    plain = F.filter(longest_first, lambda x: ~F.array_contains(ordinary, x["norm"]))
    every = any_of(longest_first)
    # An ordinary word counts after a word in small letters, or beside a name.
    beside = F.concat(F.lit(r"(?:(?<=\p{Ll}\x20)|(?<=(?iu:"), every, F.lit(r")\x20)|(?=\p{L}++\x20(?=\p{Lu})(?iu:"),
                      every, F.lit(")" + _WORD_ENDS + "))"))
    common = F.when(F.size(words) > 0, F.concat(beside, F.lit("(?iu:"), any_of(words), F.lit(")"))).otherwise("(?!)")
    rare = F.when(F.size(plain) > 0, F.concat(F.lit("(?iu:"), any_of(plain), F.lit(")"))).otherwise("(?!)")
    pattern = F.concat(F.lit(_NOT_IN_WORD + r"(?=\p{Lu})("), rare, F.lit("|"), common, F.lit(")" + _WORD_ENDS))

    def one(gap: Column, g: Column) -> Column:
        def surrogate_of(w: Column) -> Column:
            same = F.filter(names, lambda x: x["norm"] == F.lower(w))
            before = F.filter(same, lambda x: x["i"] < g)
            s = F.coalesce(F.get(before, F.size(before) - 1)["s"], F.get(same, F.lit(0))["s"])
            return F.coalesce(_name_like(w, s), w)

        found = F.regexp_extract_all(gap, pattern, F.lit(1))
        text = F.array_join(F.zip_with(F.split(gap, pattern, -1), F.transform(found, surrogate_of),
                                       lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
        return F.struct(text.alias("text"), F.size(found).alias("n"))

    return F.when(F.size(names) > 0, F.transform(gaps, one)).otherwise(
        F.transform(gaps, lambda gap: F.struct(gap.alias("text"), F.lit(0).alias("n"))))


def rendered(kind: Column, raw: Column, norm: Column, s: Column) -> Column:
    """The surrogate in the format of this occurrence."""
    def in_format(wanted: str, lead: Column, s: Column = s) -> Column:
        """Each wanted character of ``raw`` in turn, after the first ``lead``,
        becomes the next of ``s``; what is left of ``s`` follows."""
        count = lambda x: F.length(F.regexp_replace(x, f"[^{wanted}]", ""))

        def one(i: Column) -> Column:
            c, k = F.substring(raw, i, F.lit(1)), count(F.substring(raw, F.lit(1), i)) - lead
            return F.when(F.rlike(c, F.lit(f"[{wanted}]")) & (k > 0), F.substring(s, k, F.lit(1))).otherwise(c)

        rest = F.substring(s, count(raw) - lead + 1, F.length(s))
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.length(raw)), one), ""), rest)

    def cased(i: Column) -> Column:
        c = F.substring(s, i, F.lit(1))
        return F.when(F.rlike(F.substring(raw, i, F.lit(1)), F.lit(r"\p{Lu}")), F.upper(c)).otherwise(c)

    digits = F.length(F.regexp_replace(raw, "[^0-9]", ""))
    as_written = F.array_join(F.transform(F.sequence(F.lit(1), F.length(s)), cased), "")
    name = _name_like(raw, s)
    return (F.when(kind.isin("card", "ssn"), in_format("0-9", F.lit(0)))
            .when(kind == "phone", in_format("0-9", digits - F.length(F.regexp_replace(norm, "[^0-9]", "")),
                                             F.regexp_replace(s, "[^0-9]", "")))
            .when(kind == "iban", in_format("0-9A-Z", F.lit(0)))
            .when(kind.isin("name_m", "name_f"), name)
            .when(kind == "email", as_written).otherwise(s))


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """(kind, norm, s) of the distinct entities in ``found`` (kind, norm):
    every s is of one entity only and is none of the entities itself."""
    todo = stored(found.select("kind", "norm").distinct(), "entities")
    real = todo.select(F.col("kind").alias("rk"), F.col("norm").alias("rn"))
    done = todo.limit(0).withColumn("s", F.lit(""))
    for draw in itertools.count():  # the space of surrogates grows on the way
        drawn = todo.withColumn("s", surrogate(key, F.col("kind"), F.col("norm"), draw))
        won = drawn.groupBy("kind", "s").agg(F.min("norm").alias("norm"))
        won = won.join(real, (won.kind == F.col("rk")) & (won.s == F.col("rn")), "left_anti")
        if draw:
            taken = done.select(F.col("kind").alias("tk"), F.col("s").alias("ts"))
            won = won.join(taken, (won.kind == F.col("tk")) & (won.s == F.col("ts")), "left_anti")
        won = stored(won.select("kind", "norm", "s"), "surrogates")
        done = done.unionByName(won) if draw else won
        todo = stored(todo.join(won.select("kind", "norm"), ["kind", "norm"], "left_anti"), "entities")
        if todo.isEmpty():
            return done


def replace_pii(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, with every entity in the text
    replaced; two more columns, ``n_replaced`` (long) and ``kinds`` (the kinds
    found, sorted, comma-joined), under names that no column has.

    Null texts stay null, texts without entities stay as they are, very long
    ones are read whole; repeated
    rows get the same surrogates; an empty table gives no rows.  The rows
    with entities are numbered and written once: ids that a later read would
    give follow its splits, which may have changed by then."""
    n_col, k_col = (_free(docs, c) for c in ("n_replaced", "kinds"))
    row = F.struct(*[docs[c] for c in docs.columns])
    src = docs.select(row.alias("_row"), docs[text_col].alias("_text"))
    has = F.coalesce(may_have(F.col("_text")) & F.rlike("_text", F.lit(PATTERN)), F.lit(False))
    hit = stored(src.where(has).select("_row", F.monotonically_increasing_id().alias("_rid")), "hits")
    hit = hit.withColumn("_text", F.col("_row").getField(text_col))
    seen = hit.select("_rid", F.inline(entities(F.col("_text")))).withColumn(
        "norm", normal(F.col("kind"), F.col("raw")))
    seen = stored(seen, "occurrences")
    made = surrogates(seen, key)
    norm = F.when(F.col("kind").isin("name_m", "name_f"), F.col("norm"))
    new = (seen.join(made, ["kind", "norm"])
           .select("_rid", "i", "kind", norm.alias("name_norm"), "s",
                   rendered(F.col("kind"), F.col("raw"), F.col("norm"), F.col("s")).alias("r"))
           .groupBy("_rid").agg(F.sort_array(F.collect_list(F.struct("i", "r", F.col("name_norm").alias("norm"), "s"))).alias("_new"),
                                F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("_kinds")))
    joined = hit.join(new, "_rid").withColumn("_gaps", F.split("_text", PATTERN, -1))
    joined = joined.withColumn("_gaps", bare_mentions(F.col("_gaps"), F.col("_new")))
    parts = F.zip_with("_gaps", F.transform("_new", lambda x: x["r"]),
                       lambda g, r: F.concat(g["text"], F.coalesce(r, F.lit(""))))
    bare = F.aggregate("_gaps", F.lit(0), lambda a, g: a + g["n"])
    joined = joined.withColumns({"_text": F.array_join(parts, ""),
                                 "_n": (F.size("_new") + bare).cast("long")})
    plain = src.where(~has).select("_row", "_text", F.lit(0).cast("long").alias("_n"), F.lit("").alias("_kinds"))
    out = plain.unionByName(joined.select("_row", "_text", "_n", "_kinds"))
    cols = [F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns]
    return out.select(*cols, F.col("_n").alias(n_col), F.col("_kinds").alias(k_col))


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
