"""Personal data replaced by surrogates, in DataFrame functions alone.

Entities are found by one pattern and brought into a canonical form.  Each distinct entity gets
a surrogate that depends on a secret key, its type and its canonical form, so it is the same
wherever the entity occurs; letters stay letters of their script and case, digits digits, and
names get names of the title's gender.  Surrogates that two entities share, or that are
themselves an entity of the data, are drawn anew until none is left; the space that they are
drawn from grows with the draws.  Each occurrence then takes
the surrogate in its own spelling (separators, capitals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, shared

#: Titles with the gender of who bears them.
MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа")
#: Given names by script and gender.
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leon", "Martin", "Oscar", "Paul", "Robert", "Simon", "Victor"),
    ("latin", "f"): ("Alma", "Bianca", "Clara", "Diana", "Elena", "Flora", "Greta", "Helena", "Irene", "Julia", "Laura", "Maria", "Nora", "Olivia", "Paula", "Sofia"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Степан", "Тимур"),
    ("cyrillic", "f"): ("Алина", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Кира", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Софья"),
}
#: Syllables that family names are made of; a woman's in Cyrillic ends in а.
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "to", "va"),
    "cyrillic": ("ба", "бе", "бо", "да", "де", "до", "га", "го", "ка", "ке", "ко", "ла", "ле", "ло", "ма", "ме", "мо", "на", "не", "но", "ра", "ре", "ро", "са", "се", "со", "та", "те", "то", "ва", "ве", "во"),
}
#: The letters that a letter may become, by script and case.
ALPHABETS = (
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïñòóôõöøùúûüýß", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
)

_TITLES = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
#: One pattern for each type; in a text they are tried in this order at every place.  A group
#: without a bound is possessive: Java's matcher would otherwise recurse once a repeat.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)++",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-fA-F]{32,}+|AKIA[0-9A-Z]{16}|sk-[0-9A-Za-z]{20,}+|gh[pousr]_[0-9A-Za-z]{20,}+)(?![\p{L}\p{N}])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "phone": r"(?<![\d+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}(?!\d)",
    "card": r"(?<![\d.\-])\d{4}[ \-]?\d{4}[ \-]?\d{4}[ \-]?\d{4}(?![\d]|[.\-]\d)",
    "national": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Draws after which what is left gets a surrogate that is distinct by itself: no form has been
#: seen to need so many.
MOST_DRAWS = 60
#: After each so many draws the space grows: names by a syllable, the local part of an address
#: by a letter, phone and national numbers by a digit; octets get any number of digits.
GROWS_AFTER = 4
#: The key used if none is given; production runs pass their own.
DEFAULT_KEY = "dimforge"


def _kind(raw: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(raw.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def _canonical(kind: Column, raw: Column) -> Column:
    """What all spellings of an entity share: digits of numbers, lower case of addresses and
    hexadecimal secrets, capitals of an IBAN without spaces, a name without its title's full
    stop.  Other secrets that differ by case are two."""
    return (
        F.when(kind.isin("phone", "card", "national"), F.regexp_replace(raw, r"\D", ""))
        .when((kind == "email") | ((kind == "secret") & raw.rlike("^[0-9a-fA-F]+$")), F.lower(raw))
        .when(kind == "iban", F.regexp_replace(raw, " ", ""))
        .when(kind == "name", F.regexp_replace(raw, r"^(\p{L}+)\. ", "$1 "))
        .otherwise(raw)
    )


def _draw(seed: Column, i, n: int) -> Column:
    """A number below n that the seed and a place decide."""
    return F.pmod(F.xxhash64(seed, i), F.lit(n)).cast("int")


def _characters(text: Column, seed: Column, keep: Column | None = None) -> Column:
    """Every letter and digit replaced by one of its own alphabet; the first ``keep``
    characters and all others stay."""

    def one(c, i):
        out = c
        for alphabet in reversed(ALPHABETS):
            out = F.when(F.lit(alphabet).contains(c), F.substring(F.lit(alphabet), _draw(seed, i, len(alphabet)) + 1, F.lit(1))).otherwise(out)
        return out if keep is None else F.when(i < keep, c).otherwise(out)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _digit_sum(digits: Column) -> Column:
    """The Luhn sum of a number's digits, mod 10."""
    reverse = F.reverse(F.split(digits, ""))
    doubled = F.transform(reverse, lambda d, i: F.when(i % 2 == 1, (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")).otherwise(d.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10


def _more(extra: Column, seed: Column, values: tuple | str, first: int) -> Column:
    """``extra`` further values in a row, drawn at the places from ``first`` on."""
    return F.when(extra > 0, F.array_join(F.transform(F.sequence(F.lit(first), F.lit(first - 1) + extra), lambda i: _pick(tuple(values), seed, i)), "")).otherwise("")


def _octets(ip: Column, seed: Column, extra: Column) -> Column:
    """Octets of as many digits as before, of any number once the space has grown."""

    def one(o, i):
        return F.when(extra > 0, _draw(seed, i, 255) + 1).when(F.length(o) == 1, _draw(seed, i, 9) + 1).when(F.length(o) == 2, _draw(seed, i, 90) + 10).otherwise(_draw(seed, i, 155) + 100).cast("string")

    return F.array_join(F.transform(F.split(ip, r"\."), one), ".")


def _pick(values: tuple, seed: Column, i) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _draw(seed, i if isinstance(i, Column) else F.lit(i), len(values)) + 1)


def _name(text: Column, seed: Column, extra: Column) -> Column:
    """The title, a given name of its gender if there were two names, and a family name."""
    title = F.substring_index(text, " ", 1)
    two = F.size(F.split(text, " ")) > 2

    def of(script, gender):
        syllables = [_pick(SYLLABLES[script], seed, i) for i in range(1, 4)]
        ending = {("cyrillic", "m"): "нов", ("cyrillic", "f"): "нова"}.get((script, gender), "n")
        family = F.concat(F.initcap(F.concat(*syllables)), _more(extra, seed, SYLLABLES[script], 4), F.lit(ending))
        return F.concat(title, F.when(two, F.concat(F.lit(" "), _pick(GIVEN[script, gender], seed, 0))).otherwise(""), F.lit(" "), family)

    cyrillic, male = F.substring_index(text, " ", -1).rlike(r"^\p{IsCyrillic}"), title.isin(*MALE)
    return F.when(cyrillic, F.when(male, of("cyrillic", "m")).otherwise(of("cyrillic", "f"))).otherwise(F.when(male, of("latin", "m")).otherwise(of("latin", "f")))


def _seeds(kind: Column, text: Column, draw: Column, key: str) -> dict[str, Column]:
    """What a surrogate's characters are drawn by: hashes of the whole form, so that a draw
    reads no more than these, however long the form is."""
    return {
        "seed": F.sha2(F.concat_ws("\n", F.lit(key), kind, text, draw.cast("string")), 256),
        "domain_seed": F.sha2(F.concat_ws("\n", F.lit(key), F.lit("domain"), F.substring_index(text, "@", -1)), 256),
    }


def _surrogate(kind: Column, text: Column, draw: Column, seed: Column, domain_seed: Column) -> Column:
    """The surrogate of a canonical form.  Addresses of one domain share a surrogate domain, and
    the last label stays; a phone number keeps its country digit, a card its first digit, and
    its check digit fits if it did; an IBAN keeps its country."""
    extra = F.floor(draw / GROWS_AFTER).cast("int")
    digits = _more(extra, seed, "0123456789", 1000)
    domain = F.substring_index(text, "@", -1)
    host = F.regexp_extract(domain, r"^(.*)\.[^.]+$", 1)
    email = F.concat(_characters(F.substring_index(text, "@", 1), seed), _more(extra, seed, ALPHABETS[1], 1000), F.lit("@"), _characters(host, domain_seed), F.lit("."), F.substring_index(domain, ".", -1))
    card = _characters(text, seed, F.lit(1))
    body = F.substring(card, F.lit(1), F.length(card) - 1)
    fitting = F.concat(body, F.pmod(10 - _digit_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("int").cast("string"))
    hexadecimal = F.array_join(F.transform(F.split(text, ""), lambda c, i: F.substring(F.lit("0123456789abcdef"), _draw(seed, i, 16) + 1, F.lit(1))), "")
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", _octets(text, seed, extra))
        .when(kind == "card", F.when(_digit_sum(text) == 0, fitting).otherwise(card))
        .when(kind == "phone", F.concat(_characters(text, seed, F.lit(1)), digits))
        .when(kind == "national", F.concat(_characters(text, seed), digits))
        .when(kind == "iban", _characters(text, seed, F.lit(2)))
        .when(kind == "name", _name(text, seed, extra))
        .when((kind == "secret") & text.rlike("^[0-9a-f]+$"), hexadecimal)
        .when(kind == "secret", _characters(text, seed, F.when(text.startswith("AKIA") | text.startswith("gh"), 4).otherwise(3)))
        .otherwise(_characters(text, seed))
    )


def _cased(surrogate: Column, raw: Column) -> Column:
    """A surrogate with the capitals where the occurrence has them."""

    def one(a, b):
        return F.when((F.upper(b) == b) & (F.lower(b) != b), F.upper(a)).otherwise(F.coalesce(a, F.lit("")))

    return F.array_join(F.zip_with(F.split(surrogate, ""), F.split(raw, ""), one), "")


def _spelled(kind: Column, raw: Column, surrogate: Column) -> Column:
    """A surrogate in an occurrence's spelling."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def put(state, c):
        used = c.rlike(r"^\d$") | ((kind == "iban") & (c != " "))
        return F.when(used, F.struct(F.concat(state["out"], F.substring(surrogate, state["k"] + 1, F.lit(1))).alias("out"), (state["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(state["out"], c).alias("out"), state["k"].alias("k")))

    # a surrogate from a grown space is longer: the rest of it follows
    spaced = F.aggregate(F.split(raw, ""), start, put, lambda s: F.concat(s["out"], F.substring(surrogate, s["k"] + 1, F.length(surrogate))))
    address = F.concat(*[_cased(F.substring_index(surrogate, "@", k), F.substring_index(raw, "@", k)) if k else F.lit("@") for k in (1, 0, -1)])
    return (
        F.when(kind.isin("phone", "card", "national", "iban"), spaced)
        .when(kind == "email", address)
        .when((kind == "secret") & raw.rlike("^[0-9a-fA-F]+$"), F.when((F.upper(raw) == raw) & (F.lower(raw) != raw), F.upper(surrogate)).otherwise(_cased(surrogate, raw)))
        .when((kind == "name") & raw.rlike(r"^\p{L}+\. "), F.concat_ws(". ", F.substring_index(surrogate, " ", 1), F.regexp_replace(surrogate, r"^\p{L}+ ", "")))
        .otherwise(surrogate)
    )


def surrogate_table(entities: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """(kind, canonical) to (kind, canonical, surrogate).  No two entities of a kind get the
    same surrogate and none is an entity of the data.  Who drew a surrogate in fewer draws
    keeps it (ties: the smaller canonical form); the others draw again."""
    entities = shared(entities.select("kind", "canonical").distinct())
    drawn = entities.withColumn("draw", F.lit(0))
    kind, text, draw = F.col("kind"), F.col("canonical"), F.col("draw")

    def with_surrogates(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns(_seeds(kind, text, draw, key))
        return shared(rows.withColumn("surrogate", _surrogate(kind, text, draw, F.col("seed"), F.col("domain_seed"))).drop("seed", "domain_seed"))

    originals = entities.select("kind", F.col("canonical").alias("surrogate"))
    for _ in range(MOST_DRAWS):
        drawn = with_surrogates(drawn)
        first = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("draw", "canonical")).alias("first"), F.count("*").alias("n")).filter("n > 1")
        twice = drawn.join(first, ["kind", "surrogate"]).filter(F.struct("draw", "canonical") != F.col("first"))
        taken = drawn.join(originals, ["kind", "surrogate"], "left_semi")
        again = shared(twice.select("kind", "canonical").union(taken.select("kind", "canonical")).distinct())
        if again.isEmpty():
            return drawn.drop("draw")
        drawn = drawn.drop("surrogate").join(again.withColumn("more", F.lit(1)), ["kind", "canonical"], "left").select("kind", "canonical", (F.col("draw") + F.coalesce("more", F.lit(0))).alias("draw"))
    own = F.concat("surrogate", F.lit("-"), F.sha2(F.concat_ws("\n", F.lit(key), kind, text), 256))
    settled = drawn.join(again.withColumn("more", F.lit(1)), ["kind", "canonical"], "left")
    return with_surrogates(settled).select("kind", "canonical", F.when(F.col("more").isNotNull(), own).otherwise(F.col("surrogate")).alias("surrogate"))


def replace_personal_data(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY) -> DataFrame:
    """The rows and columns of ``docs`` with personal data in the text replaced, plus
    ``n_entities``, how many occurrences were.

    Defined cases: null texts stay null and empty ones empty, with 0 entities.  An entity has one
    surrogate in all rows; repeated rows stay equal.  Overlapping finds: the leftmost, at one
    place the first type of PATTERNS.  Texts of any length are whole.  A column called n_entities
    is replaced, all others are kept; an empty table gives no rows."""
    docs = docs.drop("n_entities")
    page, found = fresh(docs, "page_key"), fresh(docs, "found")
    text = F.col(text_col)
    marked = docs.withColumn(page, F.unhex(F.md5(text.cast("binary"))))
    # Equal texts are one page: copies meet as sets before anything is shuffled.
    occurrences = marked.select(F.col(page).alias("page"), F.posexplode(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).alias("place", "raw"))
    occurrences = shared(occurrences.withColumn("kind", _kind(F.col("raw"))).withColumn("canonical", _canonical(F.col("kind"), F.col("raw"))).distinct())
    table = surrogate_table(occurrences, key)
    spelled = occurrences.join(table, ["kind", "canonical"]).select("page", "place", _spelled(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("new"))
    # Written first: the join then has its own exchange, where AQE can split a page that very
    # many documents copy.
    by_page = shared(spelled.groupBy(F.col("page").alias(page)).agg(F.array_sort(F.collect_set(F.struct("place", "new"))).alias(found)))
    joined = marked.join(by_page, page, "left")
    between = F.split(text, PATTERN, -1)
    # A text is what stands between the finds and the finds, in turn.
    together = F.flatten(F.zip_with(between, F.col(found), lambda a, b: F.array(F.coalesce(a, F.lit("")), F.coalesce(b["new"], F.lit("")))))
    hit = F.col(found).isNotNull()
    return joined.withColumns({
        text_col: F.when(hit, F.array_join(together, "")).otherwise(text),
        "n_entities": F.when(hit, F.size(found)).otherwise(F.lit(0)).cast("long"),
    }).select(*docs.columns, "n_entities")
