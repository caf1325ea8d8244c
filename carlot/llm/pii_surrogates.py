"""Personal data replaced by keyed surrogates of the same type, format, gender and script.

One pattern finds all entities of a text in one pass.  Every distinct entity draws
a surrogate from a keyed hash; draws that meet another entity's surrogate, or any
real entity, are drawn again, so different entities stay different and an entity
has one surrogate everywhere.  Only lists of entities are shuffled; texts without
entities pass by.  Everything is built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.llm.names import shielded
from carlot.session import stage

_MALE = "Mr|Herr|Sr|Señor|Monsieur"
_FEMALE = "Mrs|Ms|Miss|Frau|Sra|Srta|Señora|Madame|Mme"
_ANY = "Dr|Prof"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: A word of a name; a genitive 's is not part of it.
_WORD = r"\p{Lu}(?:\p{L}|['-](?!s(?!\p{L}))(?=\p{L}))+"
#: What may repeat a name without its title.
CAPITAL = rf"(?<!\p{{L}}){_WORD}"
_SIX = r"\d[ .()-]{0,2}" * 6  # Java wants a look-behind without repeated groups
#: Kinds in order of precedence.  Every branch starts at a boundary and moves on in
#: one direction, so a long run of characters costs one scan.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)"
    # seven digits at least, all behind the plus sign
    rf"(?<={_SIX}\d)"
    r"|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    "person": rf"\b(?:{_MALE}|{_FEMALE}|{_ANY})\.? {_WORD}(?: {_WORD}){{0,2}}",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: What every entity holds: a digit, an at sign, or a title before a capital.
HINT = rf"[0-9@]|\b(?:{_MALE}|{_FEMALE}|{_ANY})\.? \p{{Lu}}"

_LATIN, _CYRILLIC, _GREEK = "abdefgiklmnoprstuvz", "абдефгиклмнопрстувз", "αβδεφγικλμνοπρστυωζ"
_PART = "array<struct<lead:string,kind:string,canon:string,raw:string>>"


def kind_of(found: Column) -> Column:
    """The first kind whose pattern covers the whole of ``found``."""
    kind = F.when(found.isNull(), F.lit(None).cast("string"))
    for name, pattern in KINDS.items():
        # lookarounds hold at both ends of the string, where nothing stands
        kind = kind.when(found.rlike(f"^(?:{pattern})$"), name)
    return kind.otherwise("phone")


def _gender(words: Column) -> Column:
    """The kind that the title of a mention gives to its given names."""
    return (
        F.when(words[0].rlike(rf"^(?:{_MALE})\.?$"), "given_m")
        .when(words[0].rlike(rf"^(?:{_FEMALE})\.?$"), "given_f")
        .otherwise("given")
    )


def _mentions(found: Column) -> Column:
    """Found entities with the kinds of their names, then the names of the text.

    A name has one kind per text: a given name that of the first gendered title
    in order of kinds, unless its own mention has one; a name alone behind a title is a given name if the
    text has it as one and not as a family name.
    """
    titled = F.filter(found, lambda f: f.rlike(f"^(?:{KINDS['person']})$"))

    def names(kind: Column | None, alone: bool = False) -> Column:
        """Names before the last one in mentions of a kind, or the last ones."""

        def of(f: Column) -> Column:
            words = F.split(f, " ")
            if kind is None:
                return F.when((F.size(words) == 2) == F.lit(alone), F.slice(words, -1, 1)).otherwise(F.slice(words, 1, 0))
            return F.when(_gender(words) == kind, F.slice(words, 2, F.size(words) - 2)).otherwise(F.slice(words, 1, 0))

        return F.array_distinct(F.transform(F.flatten(F.transform(titled, of)), F.lower))

    listed = F.struct(
        *(names(F.lit(k)).alias(k) for k in ("given", "given_f", "given_m")),
        names(None).alias("family"), names(None, alone=True).alias("alone"),
    )

    def resolved(known: Column) -> Column:
        def sex(name: Column) -> Column:
            return (
                F.when(F.array_contains(known["given_f"], name), "given_f")
                .when(F.array_contains(known["given_m"], name), "given_m")
                .when(F.array_contains(known["given"], name), "given")
            )

        def bare(name: Column) -> Column:
            return F.when(F.array_contains(known["family"], name), "family").otherwise(F.coalesce(sex(name), F.lit("family")))

        def kinds(f: Column) -> Column:
            words = F.split(f, " ")
            own = _gender(words)
            before = F.transform(
                F.slice(words, 2, F.size(words) - 2), lambda w: F.when(own == "given", sex(F.lower(w))).otherwise(own)
            )
            last = F.when(F.size(words) == 2, bare(F.lower(words[1]))).otherwise("family")
            return F.array_join(F.concat(before, F.array(last)), ",")

        said = F.transform(
            found,
            lambda f: F.struct(f.alias("raw"), F.when(f.rlike(f"^(?:{KINDS['person']})$"), kinds(f)).otherwise("").alias("kinds")),
        )
        every = F.array_distinct(F.concat(*(known[k] for k in ("given_f", "given_m", "given", "family", "alone"))))
        return F.concat(said, F.transform(every, lambda n: F.struct(n.alias("raw"), F.concat(F.lit("="), bare(n)).alias("kinds"))))

    return F.transform(F.array(listed), resolved)[0]


def _parts(found: Column, kind: Column, kinds: Column) -> Column:
    """What is replaced on its own within an occurrence; ``kinds`` are those of its names."""

    def part(kind: Column, canon: Column, raw: Column, lead: Column) -> Column:
        return F.struct(lead.alias("lead"), kind.alias("kind"), canon.alias("canon"), raw.alias("raw"))

    none = F.lit("")
    canon = (
        F.when(kind == "email", F.lower(found))
        .when(kind.isin("ssn", "card", "phone"), F.regexp_replace(found, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(found, " ", ""))
        .otherwise(found)
    )
    words = F.split(found, " ")
    each = F.split(kinds, ",")
    names = F.transform(F.slice(words, 2, 3), lambda w, i: part(F.get(each, i), F.lower(w), w, F.lit(" ")))
    title = F.array(part(F.lit("literal"), words[0], words[0], none))
    alone = F.array(part(F.substring(kinds, 2, 9), found, found, none))
    return F.when(kind == "person", F.concat(title, names)).when(kind == "name", alone).otherwise(F.array(part(kind, canon, found, none))).cast(_PART)


def _noise(secret: str, attempt: int) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(secret), "kind", "canon", F.lit(str(attempt))), 512)


def _number(noise: Column, place: Column, below: int) -> Column:
    """A number below ``below`` from the noise at ``place``; places repeat after 60."""
    return (F.conv(F.substring(noise, (place % 60 * 2 + 1).cast("int"), F.lit(6)), 16, 10).cast("long") % below).cast("int")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _letter(alphabet: str, at: Column) -> Column:
    return F.substring(F.lit(alphabet), at + 1, F.lit(1))


def _shaped(text: Column, noise: Column) -> Column:
    """Each letter or digit replaced by one of the same script and case; marks stay."""

    def swap(c: Column, i: Column) -> Column:
        pick = lambda alphabet: _letter(alphabet, _number(noise, i, len(alphabet)))
        upper = c.rlike(r"^\p{Lu}$")
        drawn = (
            F.when(c.rlike(r"^\d$"), pick("0123456789"))
            .when(c.rlike(r"^\p{IsCyrillic}$"), pick(_CYRILLIC))
            .when(c.rlike(r"^\p{IsGreek}$"), pick(_GREEK))
            .when(c.rlike(r"^\p{L}$"), pick("abcdefghijklmnopqrstuvwxyz"))
            .otherwise(c)
        )
        return F.when(upper, F.upper(drawn)).otherwise(drawn)

    return F.array_join(F.transform(_chars(text), swap), "")


def _digits(noise: Column, length: Column, skip: int = 0) -> Column:
    places = F.sequence(F.lit(1), F.greatest(length, F.lit(1)))
    drawn = F.array_join(F.transform(places, lambda i: _number(noise, i + skip, 10).cast("string")), "")
    return F.when(length > 0, drawn).otherwise("")


def _luhn(body: Column) -> Column:
    """The check digit of a card number without it."""
    total = F.aggregate(
        F.transform(
            F.reverse(_chars(body)),
            lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")),
        ),
        F.lit(0),
        lambda s, x: s + x,
    )
    return ((10 - total % 10) % 10).cast("string")


def _name(noise: Column, last: str, canon: Column, count: int) -> Column:
    """A name of some syllables and an ending; script as in ``canon``."""
    syllables = [
        F.concat(_letter("bdfgklmnprstvz", _number(noise, F.lit(2 * i), 14)), _letter("aeiou", _number(noise, F.lit(2 * i + 1), 5)))
        for i in range(count)
    ]
    name = F.concat(*syllables, F.lit(last))
    return (
        F.when(canon.rlike(r"\p{IsCyrillic}"), F.translate(name, _LATIN, _CYRILLIC))
        .when(canon.rlike(r"\p{IsGreek}"), F.translate(name, _LATIN, _GREEK))
        .otherwise(name)
    )


#: Values per entity that a pool has at least, so that three of four draws are free.
ROOM = 8
#: First octets of surrogate addresses, the next when the members outgrow the last.
_NETWORKS = ((10, 1), (240, 16), (0, 256))


def _syllables(members: int) -> int:
    """Syllables in a name that is one of ``ROOM`` times as many as there are members."""
    count = 3
    while 70**count < ROOM * members:
        count += 1
    return count


def _drawn(secret: str, attempt: int, members: dict[str, int]) -> Column:
    """The surrogate of the columns ``kind`` and ``canon`` at an attempt.

    Pools of names and addresses follow ``members``, the entities per kind; those of
    short mail addresses grow by letters in front from the third attempt on.
    """
    kind, canon, noise = F.col("kind"), F.col("canon"), _noise(secret, attempt)
    size = F.length(canon)
    country = F.greatest(size - 10, F.lit(0))
    tld = F.substring_index(canon, ".", -1)
    body = F.substring(canon, F.lit(1), size - F.length(tld))
    front = [_letter("abcdefghijklmnopqrstuvwxyz", _number(noise, F.lit(59 - i), 26)) for i in range(max(0, attempt - 1))]
    many = members.get("ip", 0)
    base, nets = next((n for n in _NETWORKS if n[1] << 24 >= ROOM * many), _NETWORKS[-1])
    octets = [_number(noise, F.lit(i), 256).cast("string") for i in range(3)]
    net = (_number(noise, F.lit(9), nets) + base).cast("string")
    card = F.concat(F.substring(canon, 1, 1), _digits(noise, size - 2))
    name = lambda last, kind: _name(noise, last, canon, _syllables(members.get(kind, 0)))
    return (
        F.when(kind == "email", F.concat(*front, _shaped(body, noise), tld))
        .when(kind == "ip", F.concat_ws(".", net, *octets))
        .when(kind == "card", F.concat(card, _luhn(card)))
        .when(kind == "phone", F.concat(F.substring(canon, F.lit(1), country), _digits(noise, size - country)))
        .when(kind == "iban", F.concat(F.substring(canon, 1, 2), _shaped(F.substring(canon, F.lit(3), size), noise)))
        .when(kind == "given_f", name("na", "given_f"))
        .when(kind == "given_m", name("ros", "given_m"))
        .when(kind == "given", name("mis", "given"))
        .when(kind == "family", name("dez", "family"))
        .otherwise(_digits(noise, size))
    )


def _shape(kind: Column, canon: Column) -> Column:
    """What a surrogate of fixed length keeps, and how many values share it."""
    size = F.length(canon)
    kept = F.when(kind == "phone", F.greatest(size - 10, F.lit(0))).when(kind == "card", F.lit(1)).otherwise(F.lit(0))
    free = size - kept - F.when(kind == "card", 1).otherwise(0)
    return F.struct(
        F.when(kind == "ip", F.lit("")).otherwise(F.substring(canon, F.lit(1), kept)).alias("lead"),
        F.when(kind == "ip", 4).otherwise(free).alias("free"),
        F.when(kind == "ip", 2.0**32).otherwise(F.pow(F.lit(10.0), free)).alias("values"),
    )


def _stepped(secret: str, left: Column, right: Column, lefts: Column, rights: Column, label: Column) -> Column:
    """The pair of numbers after (left, right) in a keyed order of all pairs.

    The order is an alternating Feistel network: a pair is hidden, counted up by one
    and shown again.  So all results differ, and none is its own pair.
    """

    def wave(i: Column, half: Column) -> Column:
        hashed = F.sha2(F.concat_ws("\u0001", F.lit(secret), label, i.cast("string"), half.cast("string")), 256)
        return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long")

    def pair(left: Column, right: Column) -> Column:
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def below(i: Column) -> Column:
        return F.when(i % 2 == 0, lefts).otherwise(rights)

    rounds = [F.lit(i) for i in range(10)]
    hidden = F.aggregate(
        F.array(*rounds), pair(left, right), lambda s, i: pair(s["r"], F.pmod(s["l"] + wave(i, s["r"]), below(i)))
    )
    turned = F.transform(
        F.array(hidden),
        lambda h: pair(F.when(h["r"] + 1 < rights, h["l"]).otherwise((h["l"] + 1) % lefts), (h["r"] + 1) % rights),
    )[0]
    return F.aggregate(
        F.array(*reversed(rounds)), turned, lambda s, i: pair(F.pmod(s["r"] - wave(i, s["l"]), below(i)), s["l"])
    )


def _permuted(secret: str) -> Column:
    """A surrogate of the same shape for kinds of fixed length, different for all values."""
    kind, canon, lead, free = F.col("kind"), F.col("canon"), F.col("shape.lead"), F.col("shape.free")
    label = F.concat_ws("\u0001", "kind", lead, free.cast("string"))
    half = F.floor(free / 2).cast("int")
    power = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
    at = F.length(lead) + 1
    first, second = F.substring(canon, at, half).cast("long"), F.substring(canon, at + half, free - half).cast("long")
    next_digits = _stepped(secret, first, second, power(half), power(free - half), label)
    number = F.transform(
        F.array(next_digits),
        lambda p: F.concat(lead, F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), free - half, "0")),
    )[0]
    octets = F.split(canon, r"\.").cast("array<long>")
    word = F.lit(1 << 16).cast("long")
    next_words = _stepped(
        secret, F.get(octets, F.lit(0)) * 256 + F.get(octets, F.lit(1)), F.get(octets, F.lit(2)) * 256 + F.get(octets, F.lit(3)), word, word, label
    )
    address = F.transform(
        F.array(next_words),
        lambda p: F.concat_ws(".", *(x.cast("string") for h in ("l", "r") for x in (F.shiftright(p[h], 8), p[h] % 256))),
    )[0]
    return F.when(kind == "ip", address).when(kind == "card", F.concat(number, _luhn(number))).otherwise(number)


def surrogates(entities: DataFrame, secret: str, attempts: int = 40) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon): one each, all different.

    A draw is taken if no other entity has it and it is no entity itself; of equal
    draws the least entity keeps it and the others go on.  Pools of names, mail and
    ip addresses grow with the entities.  Numbers cannot: where more than one in
    ``ROOM`` of the values of a shape are entities, a keyed permutation of that
    shape gives each another value, which may be an entity's.
    """
    entities = stage(entities.distinct(), "entities")
    members = {r["kind"]: r["count"] for r in entities.groupBy("kind").count().collect()}
    left, done = entities, None
    fixed = entities.filter(F.col("kind").isin("ssn", "phone", "card", "ip"))
    fixed = fixed.withColumn("shape", _shape(F.col("kind"), F.col("canon")))
    full = fixed.groupBy("kind", "shape").count().filter(F.col("count") * ROOM > F.col("shape.values"))
    full = stage(full.select("kind", "shape"), "full-shapes")
    if not full.isEmpty():
        crowded = fixed.join(full, ["kind", "shape"], "left_semi")
        done = stage(crowded.select("kind", "canon", _permuted(secret).alias("surrogate")), "surrogates")
        left = stage(left.join(done, ["kind", "canon"], "left_anti"), "entities")
        if left.isEmpty():
            return done
    for attempt in range(attempts):
        drawn = left.withColumn("surrogate", _drawn(secret, attempt, members))
        taken = entities.select("kind", F.col("canon").alias("surrogate"))
        if done is not None:
            taken = taken.union(done.select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        won = stage(free.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")).select("kind", "canon", "surrogate"), "surrogates")
        done = won if done is None else done.union(won)
        left = stage(left.join(won, ["kind", "canon"], "left_anti"), "entities")
        if left.isEmpty():
            return done
    raise ValueError("a kind of entity has more members than its surrogates can tell apart")


def _rendered(raw: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of this occurrence."""
    filled = F.aggregate(
        _chars(raw),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("used")),
        lambda s, c: F.when(
            c.rlike("^[0-9A-Z]$"),
            F.struct(
                F.concat(s["out"], F.substring(surrogate, s["used"] + 1, F.lit(1))).alias("out"), (s["used"] + 1).alias("used")
            ),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["used"].alias("used"))),
    )["out"]
    # a mail address may have grown by letters in front
    grown = F.greatest(F.length(surrogate) - F.length(raw), F.lit(0))
    cased = F.array_join(
        F.transform(
            _chars(raw),
            lambda c, i: F.when(c.rlike(r"^\p{Lu}$"), F.upper(F.substring(surrogate, grown + i + 1, F.lit(1)))).otherwise(
                F.substring(surrogate, grown + i + 1, F.lit(1))
            ),
        ),
        "",
    )
    cased = F.concat(F.substring(surrogate, F.lit(1), grown), cased)
    name = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return (
        F.when(surrogate.isNull(), raw)
        .when(kind.isin("phone", "card", "ssn", "iban"), filled)
        .when(kind == "email", cased)
        .when(kind.isin("given", "given_f", "given_m", "family"), name)
        .otherwise(surrogate)
    )


def _count_of(types: Column, kind: str) -> Column:
    return F.size(F.filter(types, lambda t: t == kind)).cast("long")


def _bare_replaced(text: Column, names: Column) -> Column:
    """Capitalised words that are names of the map, whole or a part, replaced."""

    def new(word: Column) -> Column:
        known = F.try_element_at(names, F.lower(word))
        return F.when((word == F.upper(word)) & (F.length(word) > 1), F.upper(known)).otherwise(known)

    def part(p: Column) -> Column:
        return F.coalesce(F.when(p.rlike(r"^\p{Lu}"), new(p)), p)

    words = F.transform(
        F.regexp_extract_all(text, F.lit(CAPITAL), F.lit(0)),
        lambda w: F.coalesce(new(w), F.array_join(F.transform(F.regexp_extract_all(w, F.lit(r"\p{L}+|['-]+"), F.lit(0)), part), "")),
    )
    return _woven(F.split(text, CAPITAL, -1), words)


def _woven(kept: Column, news: Column) -> Column:
    """What is kept of a text with the new pieces between."""
    return F.array_join(
        F.transform(F.arrays_zip(kept.alias("k"), F.concat(news, F.array(F.lit(""))).alias("n")), lambda z: F.concat(z["k"], z["n"])),
        "",
    )


def replace_pii(docs: DataFrame, secret: str, text: str = "text", counts: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; other columns as they are.

    Names that a title gives away are also replaced where the same text has them,
    capitalised, without one.  A null text stays null.  With ``counts``, ``n_email`` and so on per kind are
    added, in place of columns of that name.  All other columns come back, whatever
    their names.  Rows may repeat and keys may be null: what is joined is the list of
    entities in a text, not the row.
    """
    docs, back = shielded(docs.drop(*(f"n_{k}" for k in KINDS)) if counts else docs, text)
    # the hint spares most texts the long pattern; no entity lacks it
    found = F.when(F.col(text).rlike(HINT), F.regexp_extract_all(F.col(text), F.lit(PATTERN), F.lit(0)))
    listed = docs.withColumn("__found", F.coalesce(found, F.array().cast("array<string>")))
    with_some = listed.filter(F.size("__found") > 0).withColumn("__list", F.sha2(F.array_join("__found", "\u0001"), 256))
    lists = stage(with_some.select("__list", "__found").dropDuplicates(["__list"]), "entity-lists")
    placed = lists.select("__list", F.posexplode(_mentions(F.col("__found"))).alias("at", "said"))
    placed = placed.select("__list", "at", "said.raw", "said.kinds")
    occurrences = placed.select("raw", "kinds").distinct()
    occurrences = occurrences.withColumn("type", F.when(F.col("kinds").startswith("="), "name").otherwise(kind_of(F.col("raw"))))
    parts = stage(
        occurrences.select("raw", "kinds", "type", F.posexplode(_parts(F.col("raw"), F.col("type"), F.col("kinds"))).alias("no", "part"))
        .select("raw", "kinds", "type", "no", "part.lead", "part.kind", "part.canon", F.col("part.raw").alias("piece")),
        "entity-parts",
    )
    known = surrogates(parts.filter("kind <> 'literal'").select("kind", "canon"), secret)
    shown = F.concat("lead", _rendered(F.col("piece"), F.col("kind"), F.col("surrogate")))
    written = (
        parts.join(known, ["kind", "canon"], "left")
        .groupBy("raw", "kinds", "type")
        .agg(F.sort_array(F.collect_list(F.struct("no", shown.alias("shown")))).alias("all"))
        .select("raw", "kinds", "type", F.array_join(F.transform("all", lambda p: p["shown"]), "").alias("new"))
    )
    mapped = (
        placed.join(written, ["raw", "kinds"])
        .groupBy("__list")
        .agg(F.sort_array(F.collect_list(F.struct("at", "new", "type", "raw"))).alias("__all"))
        .select(
            "__list",
            F.filter("__all", lambda n: n["type"] != "name").alias("__new"),
            F.filter("__all", lambda n: n["type"] == "name").alias("__names"),
        )
    )
    kept = F.split(F.col(text), PATTERN, -1)
    names = F.map_from_arrays(F.transform("__names", lambda n: n["raw"]), F.transform("__names", lambda n: n["new"]))
    kept = F.when(F.size("__names") > 0, F.transform(kept, lambda k: _bare_replaced(k, F.col("__map")))).otherwise(kept)
    joined = _woven(kept, F.transform("__new", lambda n: n["new"]))
    columns = [F.col(c) for c in docs.columns]
    types = F.transform("__new", lambda n: n["type"])
    totals = [_count_of(types, k).alias(f"n_{k}") for k in KINDS] if counts else []
    zeros = [F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS] if counts else []
    changed = with_some.join(mapped.withColumn("__map", names).drop("__all"), "__list").select(
        *(joined.alias(text) if c == text else F.col(c) for c in docs.columns), *totals
    )
    return back(changed.unionByName(listed.filter(F.size("__found") == 0).select(*columns, *zeros)))


def op1_pii(spark: SparkSession, sf_dir: str, secret: str = "rotate-this-key") -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_pii(docs, secret, counts=True)
