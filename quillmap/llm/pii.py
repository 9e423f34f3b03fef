"""PII surrogates, in DataFrame functions only.

Detected entities get keyed replacements of their own type, format, script and gender.
The replacement depends on the key and the entity's normal form alone, so mentions of
one entity agree everywhere. A name found with a title is also replaced where its words
stand alone in the same text. Numbers go through a keyed permutation of the numbers of
their type and length, so different ones stay different by construction; check digits
are right where they were. Replacements are checked over all entities of the table:
where two entities would share one, or one would be another entity of the table, the
later entity draws again; addresses and names get longer with each draw, so that ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmap.llm.common import written

# Honorifics by gender.
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra", "Signora", "Госпожа", "г-жа", "Κυρία"]
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "г-н", "Κύριος"]
EITHER = ["Dr", "Prof"]

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
#: By type, in the order in which they are tried at a place.
PATTERNS = {
    "EMAIL": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\p{L}\p{N}])",
    "IBAN": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "IP": rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.\d)",
    "IPV6": rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}:(?:{_HEX}(?::{_HEX}){{0,4}})?)(?![\p{{L}}\p{{N}}:])",
    "SSN": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "PASSPORT": r"(?<=\b[Pp]assport (?:[Nn]o\.? |[Nn]umber |[Nn]r\.? )?)[A-Z]{0,2}\d{6,9}(?![\p{L}\p{N}])",
    "CARD": r"(?<![\p{L}\p{N}.-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\p{L}\p{N}])",
    "PHONE": r"(?:(?<![\p{L}\p{N}])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|(?<![\p{L}\p{N}])\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![\p{L}\p{N}.-])\d{3}(?: \d{3} |\.\d{3}\.|-\d{3}-)\d{4}|(?<=\b(?:[Tt]el|[Pp]hone|[Ff]ax|[Mm]obile|[Tt]elefon)[.:]{0,2} )0\d{2,4}[ /-]?\d{3,8}(?: \d{2,4})?)(?![\p{L}\p{N}])",
    "PERSON": r"(?<![\p{L}\p{N}])(?:" + "|".join(FEMALE + MALE + EITHER) + r")\.? \p{Lu}[\p{Ll}'’-]{1,40}(?: \p{Lu}[\p{Ll}'’-]{1,40}){0,2}(?![\p{L}\p{N}])",
}
#: Types whose replacements are permutations.
PERMUTED = ["SSN", "CARD", "PHONE", "IBAN", "PASSPORT", "IP"]
#: Rounds after which a crowded kind of numbers goes back to its first permutation, which is distinct by itself.
ROUNDS = 6
#: Most entries of the table of second draws that is broadcast.
BROADCAST_ENTRIES = 100_000
ANY = "|".join(PATTERNS.values())
#: Types that the words before a match decide: their matches by themselves, tried after all others.
ALONE = {"PASSPORT": r"[A-Z]{0,2}\d{6,9}", "PHONE": r"0\d{2,4}[ /-]?\d{3,8}(?: \d{2,4})?"}
# Alphabets for letters of each script, and syllables for names.
_ALPHABETS = {"Cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω", "Latin": "abcdefghijklmnopqrstuvwxyz"}
_ONSETS = {"Cyrillic": "бвгдзклмнпрстфхш", "Greek": "βγδζθκλμνξπρστφχ", "Latin": "bdfghjklmnprstvz"}
_VOWELS = {"Cyrillic": "аеиоу", "Greek": "αειου", "Latin": "aeiou"}
_ENDS = {"Cyrillic": ("а", "н"), "Greek": ("α", "ς"), "Latin": ("a", "n")}


def _let(value: Column, f) -> Column:
    """f(value), with the value worked out once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def kind(m: Column) -> Column:
    """The type of a match."""
    out = F.lit("PERSON")
    for name, pattern in reversed([*((n, p) for n, p in PATTERNS.items() if n != "PERSON"), *ALONE.items()]):
        out = F.when(m.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def _title(m: Column) -> Column:
    return F.regexp_extract(m, r"^([^ ]+?)\.? ", 1)


def _gender(m: Column) -> Column:
    """By the honorific; of a neutral one by the first name's last letter."""
    first = F.regexp_extract(m, r"^[^ ]+ ([^ ]+)", 1)
    return F.when(_title(m).isin(FEMALE), "f").when(_title(m).isin(MALE), "m").when(first.rlike("[aàáeéаяαη]$"), "f").otherwise("m")


def normal(m: Column, t: Column) -> Column:
    """The form that mentions of one entity share."""
    name = F.concat(_gender(m), F.lit("|"), F.lower(F.regexp_replace(m, r"^[^ ]+ ", "")))
    return F.concat(t, F.lit(":"), F.when(t == "EMAIL", F.lower(m)).when(t == "PERSON", name).when(t == "IP", m).when(t == "IPV6", F.lower(m)).otherwise(F.regexp_replace(F.upper(m), r"[^0-9A-Z]", "")))


def _digest(key: str, *parts: Column) -> Column:
    """Hex digits that only the key's holder can compute: a keyed hash of a keyed hash."""
    return F.sha2(F.concat(F.lit(key), F.lit("/"), F.sha2(F.concat_ws("/", F.lit(key), *parts), 256)), 256)


def _draw(h: Column, i: Column) -> Column:
    """The i-th number of 16 bits in a digest."""
    return F.conv(F.substr(h, (i % F.lit(61)).cast("int") + F.lit(1), F.lit(4)), 16, 10).cast("int")


def _pick(choices: str, n: Column) -> Column:
    return F.substr(F.lit(choices), (n % F.lit(len(choices))).cast("int") + F.lit(1), F.lit(1))


def _respell(m: Column, h: Column) -> Column:
    """Digits become digits, letters become letters of their script and case; all else stays."""

    def one(c: Column, i: Column) -> Column:
        n = _draw(h, i)
        letter = F.when(c.rlike(r"\p{IsCyrillic}"), _pick(_ALPHABETS["Cyrillic"], n)).when(c.rlike(r"\p{IsGreek}"), _pick(_ALPHABETS["Greek"], n)).otherwise(_pick(_ALPHABETS["Latin"], n))
        return F.when(c.rlike("[0-9]"), (n % F.lit(10)).cast("string")).when(c.rlike(r"\p{Lu}"), F.upper(letter)).when(c.rlike(r"\p{L}"), letter).otherwise(c)

    return F.array_join(F.transform(F.split(m, ""), one), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum of a string of digits; 0 modulo 10 for valid card numbers."""

    def add(acc: Column, c: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return F.struct((acc["sum"] + F.when(acc["odd"], d).otherwise(twice)).alias("sum"), (~acc["odd"]).alias("odd"))

    return F.aggregate(F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("sum"), F.lit(True).alias("odd")), add)["sum"]


def _number(h: Column) -> Column:
    """A number below 2**60 of a digest."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def _feistel(left: Column, right: Column, most_left: Column, most_right: Column, key: str, tweak: Column) -> Column:
    """struct(l, r): a keyed permutation of the pairs of numbers below the two bounds; another one for each tweak."""

    def turn(acc: Column, k: Column) -> Column:
        own = lambda x: _number(_digest(key, F.lit("round"), tweak, k.cast("string"), x.cast("string")))
        even = k % 2 == 0
        return F.struct(F.when(even, (acc["l"] + own(acc["r"])) % most_left).otherwise(acc["l"]).alias("l"), F.when(even, acc["r"]).otherwise((acc["r"] + own(acc["l"])) % most_right).alias("r"))

    return F.aggregate(F.array(*map(F.lit, range(8))), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def permuted(digits: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the strings of as many digits."""
    n = F.length(digits)
    a = F.floor(n / 2).cast("int")
    ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
    number = lambda x: F.coalesce(F.nullif(x, F.lit("")), F.lit("0")).cast("long")
    left, right = F.substr(digits, F.lit(1), a), F.substr(digits, a + F.lit(1), n)
    of = F.concat_ws("/", tweak, n.cast("string"))
    made = _let(_feistel(number(left), number(right), ten(a), ten(n - a), key, of), lambda p: F.concat(F.when(a > 0, F.lpad(p["l"].cast("string"), a, F.lit("0"))).otherwise(F.lit("")), F.lpad(p["r"].cast("string"), n - a, F.lit("0"))))
    return F.when(n > 0, made).otherwise(digits)


def _put(m: Column, digits: Column) -> Column:
    """Other digits, as many, between the same separators."""
    return _let(F.split(m, "[0-9]", -1), lambda g: F.array_join(F.transform(g, lambda x, i: F.concat(x, F.substr(digits, i + F.lit(1), F.lit(1)))), ""))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _letters_and_digits(m: Column, key: str, tweak: Column) -> Column:
    """Digits permuted, capitals moved along the alphabet by their place and the new digits: a permutation too."""

    def spell(digits: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            by = _number(_digest(key, F.lit("letter"), tweak, digits, i.cast("string"))) % 26
            return F.when(c.rlike("[A-Z]"), F.chr((F.ascii(c) - 65 + by) % 26 + 65)).otherwise(c)

        return F.array_join(F.transform(F.split(_put(m, digits), ""), one), "")

    return _let(permuted(_digits(m), key, tweak), spell)


def _card(m: Column, key: str, tweak: Column) -> Column:
    """All digits but the last permuted, and a last one by which Luhn's sum has the rest that it had."""

    def spell(digits: Column) -> Column:
        head = F.substr(digits, F.lit(1), F.length(digits) - F.lit(1))
        rest = luhn_sum(digits) % 10
        return _let(permuted(head, key, tweak), lambda new: _put(m, F.concat(new, ((F.lit(20) - luhn_sum(F.concat(new, F.lit("0"))) % 10 + rest) % 10).cast("string"))))

    return _let(_digits(m), spell)


def mod_97(text: Column) -> Column:
    """A number's remainder by 97, letters counting as 10 to 35."""
    step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _iban(m: Column, key: str, tweak: Column) -> Column:
    """The country's letters, an account permuted, and check digits that are right if they were."""
    country, check, account = F.substr(m, F.lit(1), F.lit(2)), F.substr(m, F.lit(3), F.lit(2)), F.substr(m, F.lit(5), F.length(m))
    bare = lambda x: F.regexp_replace(x, " ", "")
    rest = mod_97(F.concat(bare(account), country, check))

    def spell(new: Column) -> Column:
        c = F.pmod(rest - mod_97(F.concat(bare(new), country, F.lit("00"))), F.lit(97))
        return F.concat(country, F.lpad(F.when(c < 2, c + 97).otherwise(c).cast("string"), 2, "0"), new)

    return _let(_letters_and_digits(account, key, F.concat_ws("/", tweak, country)), spell)


def _ip(m: Column, key: str, tweak: Column) -> Column:
    part = lambda k: F.split_part(m, F.lit("."), F.lit(k)).cast("long")
    half = F.lit(65536).cast("long")
    new = _feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), half, half, key, tweak)
    return _let(new, lambda p: F.concat_ws(".", *(x.cast("int").cast("string") for x in (F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256))))


def _person(m: Column, h: Column, key: str, attempt: Column) -> Column:
    """The honorific and new names: each word by itself, of syllables, the first of several with the gender's ending."""

    def spell(script: str, own: Column, female: Column, gendered: Column) -> Column:
        # a further draw has a further syllable
        body = F.array_join(F.transform(F.sequence(F.lit(0), attempt + 2), lambda k: F.concat(_pick(_ONSETS[script], _draw(own, k * 8)), _pick(_VOWELS[script], _draw(own, k * 8 + 4)))), "")
        end = F.when(female, _ENDS[script][0]).otherwise(F.lit(_VOWELS[script][1] + _ENDS[script][1]))
        return F.initcap(F.concat(body, F.when(gendered, F.concat(_pick(_ONSETS[script], _draw(own, F.lit(30))), end)).otherwise("")))

    def names(words: Column, female: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            gendered = (i == 0) & (F.size(words) > 1)
            return _let(
                _digest(key, F.lit("name"), F.lower(w), attempt.cast("string")),
                lambda own: F.when(w.rlike(r"\p{IsCyrillic}"), spell("Cyrillic", own, female, gendered)).when(w.rlike(r"\p{IsGreek}"), spell("Greek", own, female, gendered)).otherwise(spell("Latin", own, female, gendered)),
            )

        return F.array_join(F.transform(words, one), " ")

    words = F.split(F.regexp_replace(m, r"^[^ ]+ ", ""), " ")
    return F.concat(F.regexp_extract(m, r"^[^ ]+ ", 0), _let(words, lambda w: _let(_gender(m) == "f", lambda female: names(w, female))))


def surrogate(m: Column, t: Column, n: Column, attempt: Column, key: str) -> Column:
    """The replacement of mention m with type t and normal form n; a further attempt gives another one."""

    tweak = F.concat_ws("/", t, attempt.cast("string"))

    def by(h: Column) -> Column:
        more = F.array_join(F.transform(F.array_repeat(F.lit("0000"), attempt), lambda z, i: _respell(z, _digest(key, h, i.cast("string")))), "")
        email = F.concat(_respell(F.substring_index(m, "@", 1), h), more, F.lit("@"), _let(F.lower(F.substring_index(m, "@", -1)), lambda d: _host(d, key)))
        country = F.regexp_extract(m, r"^\+\d{1,3}", 0)
        number = F.substr(m, F.length(country) + F.lit(1), F.length(m))
        phone = F.concat(country, _put(number, permuted(_digits(number), key, F.concat_ws("/", tweak, country))))
        ipv6 = F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c.rlike("[0-9A-Fa-f]"), _pick("0123456789abcdef", _draw(_digest(key, h, (i % 4).cast("string")), i * 3))).otherwise(c)), "")
        return F.when(t == "EMAIL", email).when(t == "IP", _ip(m, key, tweak)).when(t == "IPV6", ipv6).when(t == "PHONE", phone).when(t == "CARD", _card(m, key, tweak)).when(t == "SSN", _put(m, permuted(_digits(m), key, tweak))).when(t == "PASSPORT", _letters_and_digits(m, key, tweak)).when(t == "IBAN", _iban(m, key, tweak)).otherwise(_person(m, h, key, attempt))

    return _let(_digest(key, n, attempt.cast("string")), by)


def _host(domain: Column, key: str) -> Column:
    """A host of a reserved domain, one for each domain, with its last label."""
    last = F.element_at(F.split(domain, r"\."), -1)
    return _let(_digest(key, F.lit("domain"), domain), lambda d: F.concat(*(_pick(_ALPHABETS["Latin"], _draw(d, F.lit(5 * k))) for k in range(7)), F.lit(".example."), last))


def mentions(text: Column) -> Column:
    """Array of struct(m, t, n): each mention of a text, in order."""
    maybe = text.rlike("[0-9]|::")
    for sign in ("@", *(title + dot for title in FEMALE + MALE + EITHER for dot in (" ", ". "))):
        maybe = maybe | text.contains(sign)
    found = F.when(maybe, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    typed = F.transform(found, lambda m: F.struct(m.alias("m"), kind(m).alias("t")))
    return F.transform(typed, lambda e: F.struct(e["m"].alias("m"), e["t"].alias("t"), normal(e["m"], e["t"]).alias("n")))


def attempts(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame | None:
    """n, attempt of the entities whose first draw would not be distinct; None if there is none.

    All entities of the table take part: distinct by normal form, aggregated before
    the shuffle. Of entities with one surrogate the first by normal form keeps it; an
    entity whose surrogate is an entity of the table draws again too. Numbers of one type
    and length that still meet after ROUNDS draws, because there are about as many
    entities as numbers, all go back to their first permutation: they are distinct
    then, and some are another entity's number.
    """
    seen = docs.filter(F.col(text_col).isNotNull()).select(F.explode(mentions(F.col(text_col))).alias("e")).select("e.*")
    entities = written(seen.groupBy("n").agg(F.min("m").alias("m"), F.min("t").alias("t")).withColumn("attempt", F.lit(0)), "entities")
    known = entities.select(F.col("n").alias("s"))
    settled, k = [], 0
    while True:
        drawn = written(entities.withColumn("s", _let(surrogate(F.col("m"), F.col("t"), F.col("n"), F.col("attempt"), key), lambda s: normal(s, F.col("t")))), "drawn")
        keeper = drawn.groupBy("s").agg(F.min("n").alias("keeper"), F.count(F.lit(1)).alias("sharing"))
        shared = drawn.join(keeper.filter(F.col("sharing") > 1), "s").filter(F.col("n") != F.col("keeper")).select("n")
        again = written(shared.unionByName(drawn.join(known, "s", "left_semi").select("n")).distinct(), "collisions")
        if again.isEmpty():
            break
        k += 1
        if k > ROUNDS:
            crowded = entities.join(again, "n").filter(F.col("t").isin(PERMUTED)).select("t", F.length("n").alias("size")).distinct()
            back = written(entities.join(crowded, (entities["t"] == crowded["t"]) & (F.length("n") == F.col("size")), "left_semi").select("n"), "crowded")
            entities, again = entities.join(back, "n", "left_anti"), again.join(back, "n", "left_anti")
        entities = written(entities.join(again.withColumn("__again", F.lit(1)), "n", "left").withColumn("attempt", F.col("attempt") + F.coalesce("__again", F.lit(0))).drop("__again"), "entities")
    return entities.filter(F.col("attempt") > 0).select("n", "attempt") if k else None


def names_alone(found: Column, drawn: Column, key: str) -> Column:
    """Array of struct(bare, s): the names found with a title, whole and by word, and what stands for each; the first mention of a word decides."""
    words = lambda x: F.split(F.regexp_replace(x, r"^[^ ]+ ", ""), " ")

    def of(e: Column) -> Column:
        new = words(surrogate(e["m"], e["t"], e["n"], F.coalesce(F.element_at(drawn, e["n"]), F.lit(0)), key))
        whole = F.struct(F.array_join(words(e["m"]), " ").alias("bare"), F.array_join(new, " ").alias("s"))
        return F.concat(F.array(whole), F.zip_with(words(e["m"]), new, lambda w, s: F.struct(w.alias("bare"), s.alias("s"))))

    # the longest first, as the first that fits is taken
    return F.array_sort(F.flatten(F.transform(F.filter(found, lambda e: e["t"] == "PERSON"), of)), lambda a, b: F.length(b["bare"]) - F.length(a["bare"]))


def replaced(text: Column, found: Column, drawn: Column, names: Column, key: str) -> Column:
    """struct(text, n): text with its mentions replaced and their number; drawn: map from normal form to attempt, or null;
    names: names_alone(), for which texts with a titled name are searched once more."""
    alone = F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(F.transform(names, lambda e: e["bare"]), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    new = lambda m, t, n: surrogate(m, t, n, F.coalesce(F.element_at(drawn, n), F.lit(0)), key)

    def again(m: Column) -> Column:
        known = F.filter(names, lambda e: e["bare"] == m)
        return F.when(F.size(known) > 0, F.get(known, F.lit(0))["s"]).otherwise(_let(kind(m), lambda t: _let(normal(m, t), lambda n: new(m, t, n))))

    def joined(parts: Column, gaps: Column) -> Column:
        return F.concat(F.array_join(F.transform(parts, lambda s, i: F.concat(F.get(gaps, i), s)), ""), F.element_at(gaps, -1))

    plain = joined(F.transform(found, lambda e: new(e["m"], e["t"], e["n"])), F.split(text, ANY, -1))
    more = _let(F.regexp_extract_all(text, alone, F.lit(0)), lambda ms: F.struct(joined(F.transform(ms, again), F.split(text, alone, -1)).alias("text"), F.size(ms).alias("n")))
    return F.when(F.size(found) == 0, F.struct(text.alias("text"), F.lit(0).alias("n"))).when(F.size(names) > 0, more).otherwise(F.struct(plain.alias("text"), F.size(found).alias("n")))


def with_surrogates(docs: DataFrame, key: str = "quillmap", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """docs with the text's entities replaced, and their number as count_col if named.

    All columns and rows stay; a null text stays null (0 entities), and so does a text
    without entities. Same key, same table: same result. An empty table gives an empty
    result. Repeated rows and mentions of one entity in any row agree.
    """
    own = docs.withColumn("__found", F.when(F.col(text_col).isNotNull(), mentions(F.col(text_col))).otherwise(mentions(F.lit(""))))
    again = attempts(docs, key, text_col)
    none = F.lit(None).cast("map<string,int>")
    if again is None:
        own = own.withColumn("__drawn", none)
    else:
        # the few texts with an entity that drew again, by digest
        digest = F.sha2(F.col(text_col), 256)
        named = own.select(digest.alias("__digest"), F.explode("__found.n").alias("n")).distinct().join(again, "n")
        maps = written(named.groupBy("__digest").agg(F.map_from_entries(F.collect_list(F.struct("n", "attempt"))).alias("__drawn")), "attempts")
        entries = maps.agg(F.coalesce(F.sum(F.size("__drawn")), F.lit(0))).first()[0]
        maps = F.broadcast(maps) if entries <= BROADCAST_ENTRIES else maps
        own = own.withColumn("__digest", digest).join(maps, "__digest", "left").drop("__digest")
    own = own.withColumn("__names", names_alone(F.col("__found"), F.col("__drawn"), key))
    out = own.withColumn("__new", replaced(F.col(text_col), F.col("__found"), F.col("__drawn"), F.col("__names"), key))
    columns = [F.col("__new.text").alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    return out.select(*columns, *([F.col("__new.n").alias(count_col)] if count_col else []))
