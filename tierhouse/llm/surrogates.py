"""Personal data and secrets replaced by keyed surrogates of the same type and format.

Entities are found with regular expressions. The surrogate of an entity follows from its type, its normal form and a
secret key, so the same entity gets the same surrogate wherever it stands. Surrogates are checked for collisions over
the whole corpus: of entities that share one, or meet a text that occurs in the corpus, all but the first draw again.
"""

from __future__ import annotations

import functools

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from ..operators.staging import materialize
from .common import all_equal, bound, packed, text_hash, unpacked

# Forms of address with the gender they tell (f, m or x for neither).
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Madam": "f", "Herr": "m", "Herrn": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mademoiselle": "f", "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f",
    "Señorita": "f", "Sr": "m", "Sra": "f", "Srta": "f", "Dr": "x", "Dra": "f", "Prof": "x", "Г-н": "m", "Г-жа": "f",
}
# One of a single letter, which needs its full stop.
LETTER_TITLE = {"M": "m"}
KNOWN = TITLES | LETTER_TITLE
# Syllables of made-up names by script, and endings by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fi ga go ha he ka ke ko la le li lo ma me mi mo na ne no pa pe ra re ri ro sa se".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до за зе ка ко ла ле ли ло ма ме ми мо на не но па пе ра ре ри ро са".split(),
    "greek": "βα βε βο γα γε δα δε δο ζα θα θε κα κε κο λα λε λι λο μα με μι μο να νε νο πα πε ρα ρε ρι ρο σα σε".split(),
}
ENDINGS = {
    "latin": {"f": "lina", "m": "tor", "x": "ren"},
    "cyrillic": {"f": "лина", "m": "тор", "x": "рен"},
    "greek": {"f": "λινα", "m": "τωρ", "x": "ρεν"},
}

# Repeated groups are possessive throughout: Java then runs them in a loop and not by recursion, whatever their length.
_TITLE = "(?:(?:" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")(?!\p{L})\.?|" + "|".join(LETTER_TITLE) + r"\.)"
# A name, no title itself, without the 's of a possessive.
_WORD = rf"(?!{_TITLE}(?!\p{{L}}))\p{{Lu}}(?:\p{{L}}++|['’-](?=\p{{L}})(?!s(?!\p{{L}})))++"
_TITLED = rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE} )++"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_HEXES = r"[0-9A-Fa-f]{1,4}"
# A key, quoted or not, and what follows it up to white space or a quote, without closing punctuation.
_HELD = r"[^\s\"']*[\p{L}\p{N}_+/=-]"
_KEYED = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s*[=:]\s*"
_LETTERS = r"(?=(?:[^\s\"'\p{L}\d]*[\p{L}\d]){4})"
# Digits that no digit precedes or follows, hyphens apart.
_FROM, _TO = r"(?<!\d)(?<!\d-)", r"(?!-?\d)"
_PHONES = [
    r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]?\d{3,4}",
    r"\(\d{2,4}\)\d{3,4}[ .-]?\d{3,4}",
    r"(?:(?:\+|00)\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d|0\d)(?:[ .-]?\d{2}){4}",
    r"(?:\+|00)\d{8,15}",
    r"(?:\+|00)\d{1,3}(?:[ .-]\(?\d{1,4}\)?){3,5}",
    r"(?<!\d\.)[018]?\d{10}(?!\.\d)",
]
# In order: where several fit at one place, the first one holds. Every pattern is a whole entity.
PATTERNS = {
    # The local part begins where its run of characters does, so that a long run is read once.
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "secret": rf"{_KEYED}(?:[\"'](?=[^\s\"']{{6}}){_LETTERS}{_HELD}[\"']?|(?=[^\s\"']{{8}}){_LETTERS}{_HELD})",
    "access_key": r"\bAKIA[0-9A-Z]{16}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[A-Fa-f:]*\d)(?:(?:{_HEXES}:){{7}}{_HEXES}"
            rf"|(?:{_HEXES}(?::{_HEXES}){{0,6}})?::(?:{_HEXES}(?::{_HEXES}){{0,6}})?)(?![\p{{L}}\p{{N}}]|:[0-9A-Fa-f:]|\.\d)",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\d]|\.\d)",
    "card": rf"{_FROM}(?:\d{{4}}(?:[ -]?\d{{4}}){{3}}|\d{{4}}(?:-\d{{4}}){{3}}-\d{{3}}"
            rf"|(?<!\d\.)(?:\d{{13,19}}|\d{{4}}[ -]\d{{6}}[ -]\d{{4,5}}|\d{{4}}(?:[ -]\d{{3}}){{3}})){_TO}",
    "social": rf"{_FROM}\d{{3}}-\d{{2}}-\d{{4}}{_TO}",
    "phone": rf"(?<![\p{{L}}\d])(?<!\d-)(?:{'|'.join(_PHONES)}){_TO}",
    "name": rf"{_TITLED}{_WORD}(?: {_WORD})?+",
}
# Every text with an entity has a place that fits this.
HINT = rf"[0-9@=:]|AKIA|{_TITLED}\p{{Lu}}"
EVERY = "|".join(f"(?:{p})" for p in PATTERNS.values())
HEX, DIGITS, UPPER, LOWER = "0123456789abcdef", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_DRAWS = 20


def type_of(entity: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(entity.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    # What only its surroundings made an entity is told by its shape.
    return F.coalesce(kind, F.when(entity.rlike("[0-9=:@]"), "card").otherwise("name"))


def untitled(mention: Column) -> Column:
    return F.regexp_replace(mention, f"^{_TITLED}", "")


def normal_form(entity: Column, kind: Column) -> Column:
    """Mentions with the same normal form are one entity: case, separators and titles do not count."""
    plain = F.lower(entity)
    digits = F.regexp_replace(entity, r"\D", "")
    name = F.lower(untitled(entity))
    held = F.regexp_extract(entity, rf"[=:]\s*[\"']?({_HELD})", 1)
    return (
        F.when(kind.isin("card", "social", "phone"), digits).when(kind == "secret", held).when(kind == "name", name)
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit(""))).otherwise(plain)
    )


def _stream(seed: Column) -> Column:
    """Numbers 0 to 255, 64 of them, from a keyed hash."""
    hexed = F.concat(F.sha2(seed, 256), F.sha2(F.concat(F.lit("2"), seed), 256))
    return F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.conv(F.substring(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
    )


def _same_shape(text: Column, numbers: Column) -> Column:
    """Each digit, ASCII letter or other letter of a text replaced by one of its own kind; the rest stays."""
    def new(c: Column, i: Column) -> Column:
        n = F.get(numbers, i % F.size(numbers)) + F.floor(i / F.size(numbers)).cast("int")

        def of(letters: str) -> Column:
            return F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))

        return (
            F.when(c.rlike("[0-9]"), of(DIGITS)).when(c.rlike("[A-Z]"), of(UPPER)).when(c.rlike("[a-z]"), of(LOWER))
            .when(c.rlike(r"\p{Lu}"), of("ÄÖÜÉÈÇÑÅ")).when(c.rlike(r"\p{L}"), of("äöüéèçñå")).otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), new), "")


def _hex_shape(text: Column, numbers: Column) -> Column:
    """As ``_same_shape`` within hexadecimal digits of the same case."""
    def new(c: Column, i: Column) -> Column:
        n = F.get(numbers, i % 64) + F.floor(i / 64).cast("int")
        digit = F.substring(F.lit(HEX), n % 16 + 1, F.lit(1))
        return F.when(c.rlike("[0-9a-f]"), digit).when(c.rlike("[A-F]"), F.upper(digit)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), new), "")


def _name(gender: Column, script: Column, numbers: Column, parts: Column, draw: Column) -> Column:
    """One or two made-up names; a first name ends as its gender has it. Later draws are longer."""
    def word(first: int, ending: Column | None) -> Column:
        made = F.lit(None).cast("string")
        for of, known in SYLLABLES.items():
            one = functools.partial(F.get, F.array(*map(F.lit, known)))
            syllables = [one(F.get(numbers, F.lit(first + k)) % len(known)) for k in range(7)]
            built = F.concat(*syllables[:3], F.when(draw < 2, "").otherwise(F.concat(*syllables[3:])))
            made = F.when(script == of, built).otherwise(made)
        return F.initcap(made if ending is None else F.concat(made, ending))

    ending = F.lit(None).cast("string")
    for script_name, by_gender in ENDINGS.items():
        for g, text in by_gender.items():
            ending = F.when((script == script_name) & (gender == g), text).otherwise(ending)
    return F.when(parts > 1, F.concat(word(0, ending), F.lit(" "), word(8, None))).otherwise(word(8, ending))


def gender_of(mention: Column) -> Column:
    """The gender that the form of address tells; the first one that tells any counts."""
    titles = F.split(F.regexp_replace(F.regexp_extract(mention, f"^{_TITLED}", 0), r"\.", ""), " ")
    told = F.filter(titles, lambda t: t.isin(*[t for t, g in KNOWN.items() if g != "x"]))
    genders = F.create_map(*[F.lit(x) for t, g in KNOWN.items() for x in (t, g)])
    return F.coalesce(F.element_at(genders, F.get(told, F.lit(0))), F.lit("x"))


def script_of(mention: Column) -> Column:
    rest = untitled(mention)
    return F.when(rest.rlike(r"\p{IsCyrillic}"), "cyrillic").when(rest.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def surrogate(kind: Column, normal: Column, gender: Column, script: Column, key: str, draw: Column) -> Column:
    """The ``draw``-th surrogate of an entity, in normal form."""
    seed = F.concat_ws("|", F.lit(key), kind, normal, draw.cast("string"))

    def made(numbers: Column) -> Column:
        octets = F.array_join(
            F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.get(numbers, i) % 254 + 1).cast("string")), "."
        )
        local = _same_shape(F.substring_index(normal, "@", 1), numbers)
        # Example domains are reserved: no surrogate is an address that somebody owns.
        host = _same_shape(F.lit("owned"), F.slice(numbers, 41, 8))
        mail = F.concat(local, F.lit("@"), host, F.lit(".example.net"))
        is_hex = normal.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        shaped = F.when((kind == "secret") & is_hex, _hex_shape(normal, numbers)).otherwise(_same_shape(normal, numbers))
        key_id = F.concat(F.lit("AKIA"), F.upper(_same_shape(F.substring(normal, 5, 16), numbers)))
        iban = F.concat(F.substring(normal, 1, 2), _same_shape(F.substring(normal, 3, 64), numbers))
        # Short addresses leave little room: later draws are whole ones of the range for documentation.
        groups = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.concat(*(
            F.substring(F.lit(HEX), F.get(numbers, i * 4 + j) % 16 + 1, F.lit(1)) for j in range(4))))
        long_ip = F.concat(F.lit("2001:db8:"), F.array_join(groups, ":"))
        ipv6 = F.when(draw < 2, _hex_shape(normal, numbers)).otherwise(long_ip)
        name = _name(gender, script, numbers, F.size(F.split(normal, " ")), draw)
        return (
            F.when(kind == "email", mail).when(kind == "ip", octets).when(kind == "ipv6", ipv6).when(kind == "access_key", key_id)
            .when(kind == "iban", iban).when(kind == "name", name).otherwise(shaped)
        )

    return bound(_stream(seed), made)


def rendered(mention: Column, kind: Column, normal: Column, new: Column, part: Column) -> Column:
    """A surrogate in the format of one mention: its separators, title and case, and its ``part`` of a name."""
    def fill(digits: Column) -> Column:
        count = F.lit(0)
        chars = F.split(mention, "")
        state = F.aggregate(
            chars, F.struct(F.lit("").alias("out"), count.alias("n")),
            lambda s, c: F.when(
                c.rlike("[A-Za-z0-9]"),
                F.struct(F.concat(s["out"], F.substring(digits, s["n"] + 1, F.lit(1))).alias("out"), (s["n"] + 1).alias("n")),
            ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["n"].alias("n"))),
        )
        return state["out"]

    title = F.regexp_extract(mention, f"^{_TITLED}", 0)
    held = untitled(mention)
    shouted = (F.upper(held) == held) & (F.lower(held) != held)
    new = F.when(part == "first", F.substring_index(new, " ", 1)).when(part == "last", F.substring_index(new, " ", -1)).otherwise(new)
    plain = F.when(shouted, F.upper(new)).otherwise(new)
    return (
        F.when(kind.isin("card", "social", "phone", "iban"), fill(new))
        .when(kind == "secret", F.concat(
            F.regexp_extract(mention, rf"^({_KEYED}[\"']?)", 1), new, F.regexp_extract(mention, r"([\"']?)$", 1)))
        .when(kind == "name", F.concat(title, plain)).when(kind == "access_key", new).otherwise(plain)
    )


def every_with(names: Column) -> Column:
    """``EVERY`` and the given names, the longest first, as whole words."""
    longest = F.transform(
        F.sort_array(F.transform(names, lambda n: F.struct((-F.length(n)).alias("less"), n.alias("name")))), lambda s: s["name"]
    )
    known = F.concat(
        F.lit(EVERY + r"|(?<![\p{L}\p{N}])(?=\p{Lu})(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])")
    )
    return F.when(F.size(names) > 0, known).otherwise(F.lit(EVERY))


def _names_of(held: Column, text: Column) -> Column:
    """The ways a document may repeat its titled names: whole, in capitals, and each of their words.

    A word that the document also has in lower case is no name where it stands alone.
    """
    whole = F.transform(F.filter(held, lambda m: m.rlike(f"^(?:{PATTERNS['name']})$")), untitled)
    loud = F.transform(F.filter(whole, lambda n: n.contains(" ")), F.upper)
    each = F.array_distinct(F.concat(whole, loud, F.flatten(F.transform(whole, lambda n: F.split(n, " ")))))
    plain = F.when(F.size(whole) > 0, F.array_distinct(F.split(text, r"[^\p{L}'’-]+")))
    return F.filter(each, lambda n: n.contains(" ") | ~F.coalesce(F.array_contains(plain, F.lower(n)), F.lit(False)))


def _whole_names(held: Column) -> Column:
    """The titled names of two words of a document in their order: ``gender, name``."""
    named = F.filter(held, lambda m: m.rlike(f"^(?:{PATTERNS['name']})$") & untitled(m).contains(" "))
    return F.transform(named, lambda m: F.struct(gender_of(m).alias("gender"), F.lower(untitled(m)).alias("name")))


def _referred(mention: Column, normal: Column, whole: Column) -> Column:
    """The entity of a name and the part of it that is mentioned, as a struct ``normal, part``.

    One word is the last or else the first name of a whole name of the document, of the same gender if a title tells
    it, and of the first such name if there are several; if there is none, it is an entity of its own.
    """
    gender = gender_of(mention)

    def first_with(place: int) -> Column:
        able = F.filter(whole, lambda s: (F.substring_index(s["name"], " ", place) == normal)
                        & ((gender == "x") | (s["gender"] == "x") | (s["gender"] == gender)))
        return F.coalesce(F.get(F.filter(able, lambda s: s["gender"] == gender), F.lit(0)), F.get(able, F.lit(0)))["name"]

    last, first = first_with(-1), first_with(1)
    one = ~normal.contains(" ")
    return (
        F.when(one & last.isNotNull(), F.struct(last.alias("normal"), F.lit("last").alias("part")))
        .when(one & first.isNotNull(), F.struct(first.alias("normal"), F.lit("first").alias("part")))
        .otherwise(F.struct(normal.alias("normal"), F.lit("whole").alias("part")))
    )


def mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every distinct mention of every document: ``id, hash, mention, kind, normal, part``."""
    text = F.col(text_col)
    held = docs.filter(text.rlike(HINT)).select(
        F.col(id_col).alias("id"), text_hash(text).alias("hash"), text.alias("text"),
        F.array_distinct(F.regexp_extract_all(text, F.lit(EVERY), F.lit(0))).alias("held"),
    ).filter(F.size("held") > 0)
    named = held.withColumn("names", _names_of(F.col("held"), F.col("text"))).withColumn("whole", _whole_names(F.col("held")))
    again = F.array_distinct(F.regexp_extract_all("text", every_with(F.col("names")), F.lit(0)))
    each = named.select(
        "id", "hash", "whole", F.explode(F.when(F.size("names") > 0, again).otherwise(F.col("held"))).alias("mention")
    )
    typed = each.withColumn("kind", type_of(F.col("mention")))
    normal = normal_form(F.col("mention"), F.col("kind"))
    own = F.struct(normal.alias("normal"), F.lit("whole").alias("part"))
    refers = F.when(F.col("kind") == "name", _referred(F.col("mention"), normal, F.col("whole"))).otherwise(own)
    return typed.withColumn("refers", refers).select("id", "hash", "mention", "kind", "refers.*")


def entities(found: DataFrame) -> DataFrame:
    """Every distinct entity of the corpus: ``kind, normal, gender, script``."""
    each = found.select("mention", "kind", "normal").distinct()
    formed = each.select(
        "kind", "normal",
        F.when(F.col("kind") == "name", gender_of(F.col("mention"))).otherwise("x").alias("gender"),
        F.when(F.col("kind") == "name", script_of(F.col("mention"))).otherwise("latin").alias("script"),
    )
    # A gender told by any mention holds for all of them; f and m together tell none.
    told = F.array_remove(F.collect_set("gender"), "x")
    return formed.groupBy("kind", "normal").agg(
        F.when(F.size(told) == 1, F.get(told, F.lit(0))).otherwise("x").alias("gender"), F.max("script").alias("script")
    )


def _claims(kind: Column, name: Column) -> Column:
    """What no other entity may have: the whole surrogate, and each word of a name, as it may be mentioned alone."""
    lowered = F.lower(name)
    words = F.when(kind == "name", F.split(lowered, " ")).otherwise(F.array().cast("array<string>"))
    return F.explode(F.array_distinct(F.concat(F.array(lowered), words))).alias("claim")


def assign(found: DataFrame, key: str) -> DataFrame:
    """Entities with surrogates that are all different, also in each word of names, and none of which is an entity."""
    args = F.col("kind"), F.col("normal"), F.col("gender"), F.col("script"), key
    known = materialize(found.withColumn("new", surrogate(*args, F.lit(0))), "entities")
    done = []
    for draw in range(1, MOST_DRAWS + 1):
        settled = functools.reduce(DataFrame.unionByName, done) if done else known.limit(0)
        taken = settled.select("kind", _claims(F.col("kind"), F.col("new")), F.lit(0).alias("rank"), F.lit("").alias("by"))
        real = found.select("kind", _claims(F.col("kind"), F.col("normal")), F.lit(0).alias("rank"), F.lit("").alias("by"))
        claims = known.select("kind", _claims(F.col("kind"), F.col("new")), F.lit(1).alias("rank"), F.col("normal").alias("by"))
        # A claim is lost to an earlier holder, and else to the smallest entity.
        contested = materialize(
            claims.unionByName(taken).unionByName(real).groupBy("kind", "claim")
            .agg(F.min(F.struct("rank", "by")).alias("first"), F.count("*").alias("n")).filter("n > 1")
            .select(F.col("kind").alias("of"), F.col("claim").alias("what"), "first"),
            "claims",
        )
        met = claims.join(contested, (F.col("kind") == F.col("of")) & (F.col("claim") == F.col("what")))
        losers = met.filter((F.col("first.rank") == 0) | (F.col("first.by") != F.col("by")))
        losers = losers.select(F.col("kind").alias("of"), F.col("by").alias("loser")).distinct()
        is_loser = (F.col("kind") == F.col("of")) & (F.col("normal") == F.col("loser"))
        judged = materialize(
            known.join(losers, is_loser, "left").withColumn("wins", F.col("loser").isNull()).drop("of", "loser"), "draws")
        done.append(judged.filter("wins").drop("wins"))
        again = judged.filter("not wins").drop("wins", "new")
        if again.isEmpty():
            return functools.reduce(DataFrame.unionByName, done)
        known = materialize(again.withColumn("new", surrogate(*args, F.lit(draw))), "entities")
    raise ValueError(f"entities without a surrogate of their own after {MOST_DRAWS} draws")


def pseudonymize(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows with every entity in the text replaced, and ``n_entities`` and ``kinds`` (types found, sorted).

    Emails, passwords and tokens, access keys, IBANs, IPv4 and IPv6 addresses, numbers of 13 to 19 digits (cards),
    social security and phone numbers (with separators, or 10 digits and more) and names after a form of address are
    entities, and so are further mentions of such a name in its document, whole or one of its words, without a form of
    address; they get the same surrogate or its part (a single word only if the document does not have it in lower
    case, too). A surrogate has its entity's type, length of digits and
    separators, and, for names, gender and script; titles stay. Distinct entities get distinct surrogates, no two
    names share a word of theirs, and one entity has the same everywhere. A NULL text stays NULL with no entities. Rows equal in id and text get the same result. Columns
    of these names are replaced; an empty table gives an empty result. Without the key nothing leads back to an entity.
    """
    rows = materialize(mentions(docs, id_col, text_col), "mentions")
    names = materialize(assign(materialize(entities(rows), "entities"), key), "surrogates")
    known = names.select(F.col("kind").alias("of"), F.col("normal").alias("form"), "new")
    new = rendered(F.col("mention"), F.col("kind"), F.col("normal"), F.col("new"), F.col("part"))
    bare = (F.col("kind") == "name") & (untitled(F.col("mention")) == F.col("mention"))
    per_doc = (
        rows.join(known, (F.col("kind") == F.col("of")) & (F.col("normal") == F.col("form")))
        .select(F.col("id").alias("own_id"), F.col("hash").alias("own_hash"), "kind", "mention", new.alias("new"))
        .distinct().groupBy("own_id", "own_hash")
        .agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias("by_mention"),
             F.sort_array(F.collect_set("kind")).alias("kinds"),
             F.collect_set(F.when(bare, F.col("mention"))).alias("names"))
    )
    text = F.col("row").getField(text_col)
    packs = docs.select(packed(docs), F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("hash"))
    told = packs.join(per_doc, all_equal([F.col("id"), F.col("hash")], [F.col("own_id"), F.col("own_hash")]), "left")
    every = every_with(F.coalesce("names", F.array().cast("array<string>")))
    held = F.regexp_extract_all(text, every, F.lit(0))
    pieces = F.zip_with(
        F.split(text, every, -1), held,
        lambda piece, mention: F.concat(piece, F.coalesce(F.element_at("by_mention", mention), F.lit(""))),
    )
    return unpacked(
        told, docs.columns,
        replaced={
            text_col: F.when(F.col("by_mention").isNull(), text).otherwise(F.array_join(pieces, "")),
            "n_entities": F.when(F.col("by_mention").isNull(), 0).otherwise(F.size(held)),
            "kinds": F.coalesce("kinds", F.array().cast("array<string>")),
        },
    )
