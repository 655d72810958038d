"""Surrogates for personal data: keyed, of the same type and format, and distinct.

Detected mentions are reduced to entities, so that one person or address is one
entity however it is written. An entity's surrogate is drawn by a keyed hash;
where two entities draw the same one, or one draws what occurs in the corpus,
all but the first draw again. The surrogate is then written the way each mention
was: case, punctuation and leading or trailing parts that stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.functions.binding import let
from articlelake.llm.common import name, text_hash, written

#: Draws of a given name from the lists, before syllables stand for it.
LISTED = 2
#: Ends of a given name of syllables, so that no name is drawn for both genders.
ENDS = {"latin": ("o", "a"), "cyrillic": ("ий", "ия"), "greek": ("ης", "α")}

#: Anyone who knows it can redraw the surrogates of a guessed value; give your own.
SECRET = "change me"

#: Titles that say a gender. Fixed values.
MALE = r"(?:Mr|Sr|г-н)\.?|Herr|Monsieur|Señor"
FEMALE = r"(?:Mrs|Ms|Sra|Srta|Mme|Mlle|г-жа)\.?|Frau|Miss|Madame|Señora"
GIVEN = {
    "given_m": "adam alan bruno carl daniel david erik felix hugo ivan jonas karl leon lucas marco martin oscar paul simon victor",
    "given_f": "alice anna carla clara diana elena emma eva greta helen ida julia laura lena maria nora olga rosa sara vera",
    "given_m_cyrillic": "андрей борис виктор григорий денис егор иван максим павел роман",
    "given_f_cyrillic": "алла вера галина дарья елена ирина мария нина ольга светлана",
    "given_m_greek": "αλέξανδρος ανδρέας γιώργος δημήτρης κώστας μιχάλης νίκος παύλος πέτρος στέφανος",
    "given_f_greek": "άννα βασιλική γεωργία ειρήνη ελένη ζωή κατερίνα μαρία νίκη σοφία",
}
SYLLABLES = {
    "latin": "bar del fen gar hol jen kel lin mor nev pol ras sten tol var wen",
    "cyrillic": "бар вел гор дан жел зим кол лин мор нев пол рад сол тор фен шум",
    "greek": "βαρ γελ δαν ζιν θορ καλ λιν μορ νεφ παλ ραν σολ ταρ φεν χαρ ψιλ",
}
LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
SCRIPT = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}"}

#: Words between or before the parts of a name that stay, as they tell nobody apart.
_PARTICLE = "von|vom|van|der|den|de|del|della|di|da|do|dos|das|du|des|la|las|le|los|el|al|bin|ibn|ben|bint|af|av|zu|zur|zum|ter|ten|te"
#: Initials, or a capitalised word without a possessive ending, that are no title and do not begin an address or a number.
_NAME_WORD = (
    rf"(?!(?:{FEMALE}|{MALE})(?!\p{{L}}))(?![\p{{L}}\p{{N}}._%+-]++@)(?![0-9A-F]{{32}})"
    r"(?:\p{Lu}\.(?:-?\p{Lu}\.)*+|\p{Lu}[\p{L}\p{M}]*+(?:[-'’](?!s(?!\p{L}))[\p{L}\p{M}]++)*+(?![\p{N}_]))"
)
_NAME_PART = rf"(?:(?:{_PARTICLE}) )*+{_NAME_WORD}"
#: Capitalised words in a row, which may be names without a title.
RUN = rf"(?<![\p{{L}}\p{{M}}\p{{N}}'’_-]){_NAME_WORD}(?: {_NAME_PART})*+"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Kinds in the order in which they are tried. No pattern tries a start inside a run of its own characters.
PATTERNS = {
    # Up to the last label that begins with two letters; all runs are possessive.
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:(?:\.(?!\p{L}{2})[\p{L}\p{N}-]++)*+"
    r"\.\p{L}{2,}+(?:[\p{N}-][\p{L}\p{N}-]*+(?=\.[\p{L}\p{N}-]))?+)++",
    "ip": rf"(?<![\p{{L}}\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "ssn": r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\p{L}\d-])(?:\d{4}(?:[ -]\d{4}){3}|\d{13,19})(?![\p{L}\d-])",
    "phone": r"(?<![\p{L}\d+])(?:(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}"
    r"|\+(?=(?:[ .-]?\d){5})\d++(?:[ .-]\d++)*+|(?<![.-])\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)",
    "hex": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}-])(?:{FEMALE}|{MALE})(?: {_NAME_PART})++",
}
ANY = "|".join(PATTERNS.values())


#: Kinds of the parts of a name that are replaced.
_NAMES = "^(given|surname|initial)"

#: Letters that every title of the patterns begins with or holds.
TITLES = ("Mr", "Ms", "Sr", "Mme", "Mlle", "Herr", "Frau", "Miss", "Monsieur", "Madame", "Señor", "г-")


def _may_hold(text: Column) -> Column:
    """Whether a text has what some pattern needs: a digit or @, a title, or long runs of hexadecimal letters."""
    titles = reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in TITLES])
    return text.rlike("[0-9@]") | titles | text.rlike("[a-f]{32}|[A-F]{32}")


def _kind(mention: Column) -> Column:
    """The first kind whose pattern is the whole mention. Look-arounds hold, as the mention stands alone."""
    cases = reduce(
        lambda c, k: c.when(mention.rlike(f"^(?:{PATTERNS[k]})$"), k), list(PATTERNS)[1:],
        F.when(mention.rlike(f"^(?:{PATTERNS['email']})$"), "email"),
    )
    return cases.otherwise("name")


def _script(text: Column) -> Column:
    return F.when(text.rlike(SCRIPT["cyrillic"]), "cyrillic").when(text.rlike(SCRIPT["greek"]), "greek").otherwise("latin")


def _parts(mention: Column) -> Column:
    """What a mention consists of: (kind, shape, entity) each. A name is its title and particles, which
    stay, given names or initials, and a surname, so that a name and its surname alone agree."""
    kind = _kind(mention)
    digits = F.regexp_replace(mention, r"\D", "")
    entity = (
        F.when(kind.isin("email", "hex"), F.lower(mention))
        .when(kind == "phone", F.when(F.length(digits).between(11, 13), F.substring(digits, -10, 10)).otherwise(digits))
        .when(kind.isin("ssn", "card"), digits)
        .otherwise(mention)
    )
    gender = F.when(mention.rlike(f"^(?:{FEMALE})"), "given_f").otherwise("given_m")

    def roles(words: Column) -> Column:
        is_word = lambda w, at: (at > 0) & w.rlike(r"^\p{Lu}") & ~w.endswith(".")
        last = F.array_max(F.transform(words, lambda w, at: F.when(is_word(w, at), at).otherwise(-1)))
        return let(last, lambda n: F.transform(words, lambda w, at: part(words, n, w, at)))

    def part(words: Column, last: Column, word: Column, at: Column) -> Column:
        script = _script(word)
        tail = F.when(script == "latin", "").otherwise(F.concat(F.lit("_"), script))
        bare = F.lower(F.regexp_replace(word, "[.]|(?<=[.])-", ""))
        surname = F.when(last > 0, F.lower(F.get(words, last))).otherwise("")
        letters = reduce(lambda c, k: c.when(script == k, bare.rlike(f"^[{LETTERS[k]}]+$")), LETTERS, F.when(F.lit(False), True))
        initial = word.endswith(".") & letters
        return (
            F.when(at == 0, F.struct(F.lit("title").alias("kind"), word.alias("shape"), F.lower(word).alias("entity")))
            .when(word.rlike(r"^\p{Ll}"), F.struct(F.lit("particle").alias("kind"), word.alias("shape"), word.alias("entity")))
            .when(initial, F.struct(F.concat(F.lit("initial"), tail).alias("kind"), word.alias("shape"), F.concat_ws("|", bare, surname).alias("entity")))
            .otherwise(F.struct(F.concat(F.when(at == last, "surname").otherwise(gender), tail).alias("kind"), word.alias("shape"), bare.alias("entity")))
        )

    one = F.array(F.struct(kind.alias("kind"), mention.alias("shape"), entity.alias("entity")))
    return F.when(kind == "name", let(F.split(mention, " "), roles)).otherwise(one)


#: Draws within an entity's own form before it grows.
DRAWS = 8


def _draw(hashed: Column, at) -> Column:
    """A number below 65,536 for each place, from the hexadecimal digits of a hash."""
    at = F.lit(at) if isinstance(at, int) else at
    four = F.conv(F.substring(F.concat(hashed, hashed), ((at % 31) * 4 + 1).cast("int"), 4), 16, 10).cast("int")
    return four + F.floor(at / 31).cast("int") * 7


def _substr(text: Column, at: Column, size: int = 1) -> Column:
    return F.substring(text, at.cast("int"), F.lit(size))


def _pick(values: str, number: Column) -> Column:
    words = values.split()
    return F.element_at(F.array(*[F.lit(w) for w in words]), (number % len(words) + 1).cast("int"))


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _surrogate(kind: Column, entity: Column, hashed: Column, attempt: int = 0) -> Column:
    """The characters that stand for the entity's, without punctuation but in addresses and names."""
    stem = F.when(kind == "email", F.regexp_replace(entity, r"\p{L}+$", "")).otherwise(entity)
    chars = F.split(F.regexp_replace(stem, r"[^\p{L}\p{N}]", ""), "")

    def letter(c: Column, at: Column) -> Column:
        drawn = _draw(hashed, at)
        pick = lambda letters: _substr(F.lit(letters), drawn % len(letters) + 1)
        return (
            F.when(kind == "hex", F.substring(F.lower(F.hex(drawn % 16)), -1, 1))
            .when(c.rlike(r"\p{N}"), (drawn % 10).cast("string"))
            .when(c.rlike(SCRIPT["cyrillic"]), pick(LETTERS["cyrillic"]))
            .when(c.rlike(SCRIPT["greek"]), pick(LETTERS["greek"]))
            .otherwise(pick(LETTERS["latin"]))
        )

    alike = F.array_join(F.transform(chars, letter), "")
    first = (_draw(hashed, 40) % 8 + 2).cast("string")
    head = F.concat(F.substring(entity, 1, 1), _substr_to(alike, 2, F.length(entity) - 2))
    valid = _luhn(entity)
    ends = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: _luhn(F.concat(head, d.cast("string"))) == valid)
    last = F.element_at(ends, (_draw(hashed, 41) % F.size(ends) + 1).cast("int")).cast("string")
    octets = [_draw(hashed, k) % n + a for k, (n, a) in enumerate(((223, 1), (256, 0), (256, 0), (254, 1)))]

    def by_script(use) -> Column:
        return F.when(kind.endswith("_cyrillic"), use("cyrillic")).when(kind.endswith("_greek"), use("greek")).otherwise(use("latin"))

    syllable = lambda at: by_script(lambda k: _pick(SYLLABLES[k], _draw(hashed, at)))
    # The more draws have failed, the longer names become, so that there are always enough.
    longer = [syllable(10 + n) for n in range(attempt // 4)]
    more = F.concat(F.when(_draw(hashed, 5) % 2 == 0, syllable(6)).otherwise(""), *longer)
    pair = by_script(lambda k: F.concat(*[_substr(F.lit(LETTERS[k]), _draw(hashed, n) % len(LETTERS[k]) + 1) for n in (8, 9)]))
    if attempt < LISTED:
        given = reduce(lambda c, k: c.when(kind == k, _pick(GIVEN[k], _draw(hashed, 0))), GIVEN, F.when(F.lit(False), ""))
    else:
        end = by_script(lambda k: F.when(kind.startswith("given_f"), ENDS[k][1]).otherwise(ENDS[k][0]))
        given = F.concat(syllable(1), syllable(2), syllable(3), more, end)
    # Other forms are finite, and all of one may be real: then they grow by a place a draw.
    added = range(max(0, attempt - DRAWS + 1))
    digits = F.concat(F.lit(""), *[(_draw(hashed, 12 + n) % 10).cast("string") for n in added])
    letters = F.concat(F.lit(""), *[_substr(F.lit(LETTERS["latin"]), _draw(hashed, 12 + n) % 26 + 1) for n in added])
    octets += [_draw(hashed, 12 + n) % 256 for n in added]
    return (
        F.when(kind.startswith("initial"), _initials(entity, hashed))
        .when(kind == "phone", F.concat(first, _substr_to(alike, 2, F.length(entity) - 1), digits))
        .when(kind == "ssn", F.concat(F.lit("9"), _substr_to(alike, 2, F.length(entity) - 1), digits))
        .when(kind == "card", F.concat(head, last, digits))
        .when(kind == "ip", F.concat_ws(".", *octets))
        .when(kind == "email", F.concat(alike, letters))
        .when(kind == "hex", F.concat(alike, digits))
        .when(kind.startswith("given"), given)
        .when(kind.startswith("surname"), F.concat(syllable(1), syllable(2), more, pair))
        .otherwise(alike)
    )


def _initials(entity: Column, hashed: Column) -> Column:
    """Every letter as many places further in its alphabet, the same for all initials of a surname."""

    def shifted(c: Column, letters: str) -> Column:
        place = F.instr(F.lit(letters), c) - 1 + 1 + _draw(hashed, 0) % (len(letters) - 1)
        return _substr(F.lit(letters), place % len(letters) + 1)

    script = _script(entity)
    letter = lambda c: reduce(lambda x, k: x.when(script == k, shifted(c, LETTERS[k])), LETTERS, F.when(F.lit(False), ""))
    return F.array_join(F.transform(F.split(F.regexp_replace(entity, "[|].*", ""), ""), letter), "")


def _substr_to(text: Column, start: int, size: Column) -> Column:
    return F.substring(text, F.lit(start), size.cast("int"))


def draw_surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """(kind, entity) -> (kind, entity, surrogate): no two entities of a kind share one,
    and none is an entity of the corpus. Given names and surnames count as one kind,
    so people differ in their surrogates where they differ in gender, given names or
    surname. Initials are moved within their alphabet, which keeps them apart by itself.
    Where every value of a form is real or taken, later draws make it longer, so the search ends."""
    taken, open_, attempt = None, entities.withColumn("space", F.when(F.col("kind").rlike("^(given|surname)"), "name").otherwise(F.col("kind"))), 0
    bare = F.regexp_replace(F.regexp_replace("entity", r"\p{L}+$", ""), r"[^\p{L}\p{N}]", "")
    real = open_.select("space", F.when(F.col("kind") == "email", bare).otherwise(F.col("entity")).alias("surrogate")).distinct()
    free = F.col("kind").startswith("initial")
    while True:
        who = F.when(F.col("kind").startswith("initial"), F.regexp_replace("entity", "^[^|]*", "")).otherwise(F.col("entity"))
        hashed = F.sha2(F.concat_ws("|", F.lit(secret), "kind", who, F.lit(attempt)), 512)
        drawn = open_.withColumn("hashed", hashed)
        drawn = drawn.select("space", "kind", "entity", _surrogate(F.col("kind"), F.col("entity"), F.col("hashed"), attempt).alias("surrogate"))
        firsts = drawn.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "entity")).alias("first"))
        clash = firsts.join(real, ["space", "surrogate"], "left_semi").select("space", "surrogate", F.lit(True).alias("clash"))
        if taken is not None:
            clash = clash.union(
                firsts.join(taken, ["space", "surrogate"], "left_semi").select("space", "surrogate", F.lit(True))
            ).distinct()
        judged = drawn.join(firsts, ["space", "surrogate"]).join(clash, ["space", "surrogate"], "left")
        good = free | (F.col("clash").isNull() & (F.struct("kind", "entity") == F.col("first")))
        judged = written(judged.select("space", "kind", "entity", "surrogate", good.alias("good")), "surrogates")
        accepted = judged.filter("good").select("space", "kind", "entity", "surrogate")
        taken = accepted if taken is None else taken.union(accepted)
        if attempt % 4 == 3:  # one table instead of a union of many
            taken = written(taken, "taken")
        open_ = judged.filter("NOT good").select("space", "kind", "entity")
        if open_.isEmpty():
            return taken.drop("space")
        attempt += 1


def _written_as(kind: Column, shape: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's own format."""
    own = r"[\p{L}\p{N}]"
    chars, gaps = F.regexp_extract_all(shape, F.lit(own), F.lit(0)), F.split(shape, own, -1)
    tail = F.when(kind == "email", F.length(F.regexp_extract(shape, r"\p{L}+$", 0))).otherwise(0)
    room = F.size(chars) - tail
    lead = F.greatest(room - F.length(surrogate), F.lit(0))  # as a country's prefix stays
    longer = F.when(F.length(surrogate) > room, F.substring(surrogate, room + 1, F.length(surrogate))).otherwise("")

    def put(c: Column, place: Column, news: Column) -> Column:
        new = F.get(news, place)
        return F.coalesce(F.when(c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new), c)

    fill = lambda news, before: F.transform(chars, lambda c, i: put(c, i - before, news))
    filled = let(F.split(F.substring(surrogate, F.lit(1), room), ""), lambda news: let(lead, lambda before: fill(news, before)))
    shaped = F.array_join(F.flatten(F.zip_with(gaps, filled, lambda g, c: F.array(g, F.coalesce(c, F.lit(""))))), "")
    letters = F.regexp_replace(shape, r"\P{L}", "")
    proper = F.when((F.length(letters) > 1) & (F.upper(shape) == shape), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    proper = F.concat(proper, F.when(shape.endswith("."), ".").otherwise(""))
    return (
        F.when(kind.startswith("given") | kind.startswith("surname"), proper)
        .when(kind == "ip", surrogate)
        .when(kind == "hex", F.when(shape.rlike("[A-F]"), F.upper(surrogate)).otherwise(surrogate))
        .when(kind == "email", F.concat(longer, shaped))
        .otherwise(F.concat(shaped, longer))
    )


def _people(rows: DataFrame) -> DataFrame:
    """(doc_id, hash, parts) of each name with a title, without the title; a part is (kind, entity)."""
    titles = reduce(lambda a, b: a | b, [F.contains(F.col("text"), F.lit(t)) for t in TITLES])
    named = rows.filter(titles).select("doc_id", "hash", F.explode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("mention"))
    parts = named.filter(F.col("mention").rlike(f"^(?:{PATTERNS['name']})$")).select("doc_id", "hash", _parts(F.col("mention")).alias("parts"))
    entities = F.transform(F.slice("parts", 2, F.size("parts") - 1), lambda p: F.struct(p["kind"].alias("kind"), p["entity"].alias("entity"), F.lower(p["shape"]).alias("word")))
    return parts.select("doc_id", "hash", entities.alias("parts")).distinct()


def _same_doc(other: str = "") -> Column:
    return F.col("doc_id").eqNullSafe(F.col(f"d{other}")) & (F.col("hash") == F.col(f"h{other}"))


def _untitled(runs: DataFrame, people: DataFrame) -> DataFrame:
    """(doc_id, hash, at, mention, nth, kind, shape, entity) of the words of capitalised runs that name
    a person known by a title: by the whole name anywhere, by one of its words in a document with the title or the whole name."""
    runs = runs.withColumn("words", F.split("mention", " ")).withColumn("low", F.transform("words", F.lower))
    whole = people.select("parts", F.col("parts.word").alias("name")).filter(
        (F.size("name") > 1) & F.col("name")[0].rlike(r"^(?!(?:%s)$)" % _PARTICLE) & F.exists("parts", lambda p: p["kind"].startswith("surname"))
    )
    whole = whole.groupBy("name").agg(F.min("parts").alias("parts")).withColumn("pair", F.concat_ws(" ", F.col("name")[0], F.col("name")[1]))
    begins = F.sequence(F.lit(0), F.size("low") - 2)
    pairs = F.transform(begins, lambda i: F.concat_ws(" ", F.get("low", i), F.get("low", i + 1)))
    pairs = runs.filter(F.size("low") > 1).select("*", F.posexplode(pairs).alias("begin", "pair"))
    full = pairs.join(whole, "pair").filter(F.slice("low", F.col("begin") + 1, F.size("name")) == F.col("name"))
    full = full.select("*", F.posexplode("parts").alias("k", "part")).select(
        "doc_id", "hash", "at", "mention", (F.col("begin") + F.col("k")).alias("nth"), "words", "part.kind", "part.entity", (-F.size("name")).alias("rank")
    )
    known = people.select(F.col("doc_id").alias("d"), F.col("hash").alias("h"), F.explode("parts").alias("part"))
    full = written(full, "whole-names")
    known = known.select("d", "h", "part.kind", "part.entity").union(full.select("doc_id", "hash", "kind", "entity"))
    known = known.filter("kind RLIKE '^(given|surname)'").distinct()
    docs = known.select("d", "h").distinct()
    words = runs.join(docs, _same_doc(), "left_semi").select("doc_id", "hash", "at", "mention", "words", F.posexplode("low").alias("nth", "word"))
    near = words.join(known, _same_doc() & (F.col("word") == F.regexp_replace("entity", r"[.]$", "")))
    ends = (F.col("nth") == F.size("words") - 1) == F.col("kind").startswith("surname")
    near = near.select("doc_id", "hash", "at", "mention", "nth", "words", "kind", "entity", F.when(ends, 1).otherwise(2).alias("rank"))
    best = full.unionByName(near).groupBy("doc_id", "hash", "at", "mention", "nth", "words").agg(F.min(F.struct("rank", "kind", "entity")).alias("best"))
    shape = F.get("words", F.col("nth"))
    return best.select("doc_id", "hash", "at", "mention", "nth", "best.kind", shape.alias("shape"), "best.entity").filter(~_stays(F.col("kind")))


def _stays(kind: Column) -> Column:
    return kind.isin("title", "particle")


def replace_entities(docs: DataFrame, key: str = "doc_id", text: str = "text", secret: str = SECRET) -> DataFrame:
    """One row per document: doc_id, text, n_entities.

    E-mail and IPv4 addresses, telephone, card and social security numbers,
    hexadecimal secrets and names after a title are replaced, as are whole names
    without one that have a title anywhere in the corpus, and single words of the names
    of such people in the same document; all else stays as it is. A null text
    stays null with no entities, an empty one empty. Rows of
    equal id are documents of their own; null ids are kept. Equal entities have
    equal surrogates in all documents, for one `secret` and one corpus. Other
    columns are not looked at; an empty table gives an empty result.
    """
    rows = docs.select(name(key).alias("doc_id"), name(text).alias("text"), text_hash(text).alias("hash"))
    people = written(_people(rows), "people")
    named = not people.isEmpty()
    pattern = f"{ANY}|{RUN}" if named else ANY
    holds = _may_hold(F.col("text")) | F.col("text").rlike(r"\p{Lu}") if named else _may_hold(F.col("text"))
    found = rows.filter(holds).select("doc_id", "hash", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"))
    found = found.filter(F.size("found") > 0).select("doc_id", "hash", F.posexplode("found").alias("at", "mention"))
    is_run = F.col("mention").rlike(f"^(?:{RUN})$")
    if named:
        found = written(found.withColumn("is_run", is_run), "found")
    sure = found.filter("NOT is_run").drop("is_run") if named else found
    parts = sure.select("doc_id", "hash", "at", "mention", F.posexplode(_parts(F.col("mention"))).alias("nth", "part"))
    parts = parts.select("doc_id", "hash", "at", "mention", "nth", "part.*").filter(~_stays(F.col("kind")))
    if named:
        parts = parts.unionByName(_untitled(found.filter("is_run").drop("is_run"), people))
    parts = written(parts, "mentions")
    drawn = draw_surrogates(parts.select("kind", "entity").distinct(), secret)
    done = parts.join(drawn, ["kind", "entity"]).select(
        "doc_id", "hash", "at", "mention", F.col("kind").rlike(_NAMES).alias("is_name"), "nth",
        _written_as(F.col("kind"), F.col("shape"), F.col("surrogate")).alias("new"),
    )
    each = done.groupBy("doc_id", "hash", "at", "mention", "is_name").agg(F.map_from_entries(F.collect_set(F.struct("nth", "new"))).alias("new"))
    put = F.transform(F.split("mention", " "), lambda w, i: F.coalesce(F.try_element_at("new", i), w))
    each = each.select("doc_id", "hash", "at", F.when(F.col("is_name"), F.array_join(put, " ")).otherwise(F.col("new")[0]).alias("new"))
    each = each.groupBy(F.col("doc_id").alias("d"), F.col("hash").alias("h")).agg(
        F.array_sort(F.collect_list(F.struct("at", "new"))).alias("news")
    )
    joined = rows.join(each, _same_doc(), "left")
    gaps, mentions = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    # Gaps and mentions in turn: what lies before the k-th replaced mention, its surrogate, and what follows the last.
    turns = F.flatten(F.zip_with(gaps, mentions, lambda g, m: F.array(g, F.coalesce(m, F.lit("")))))

    def whole(turn: Column) -> Column:
        news = F.col("news")
        begin = lambda k: F.when(k > 0, 2 * F.get(news, k - 1)["at"] + 2).otherwise(0)
        kept = lambda x, k: F.array_join(F.slice(turn, begin(k) + 1, 2 * x["at"] + 1 - begin(k)), "")
        rest = F.slice(turn, begin(F.size(news)) + 1, F.size(turn))
        return F.concat(F.array_join(F.transform(news, lambda x, k: F.concat(kept(x, k), x["new"])), ""), F.array_join(rest, ""))

    return joined.select(
        "doc_id",
        F.when(F.col("news").isNull(), F.col("text")).otherwise(let(turns, whole)).alias("text"),
        F.coalesce(F.size("news"), F.lit(0)).cast("long").alias("n_entities"),
    )
