"""Surrogates for personal data, from built-in functions only.

Entities are found by one pattern; each has a type and a canonical form (letter case, separators and a phone's country
code left out), so that spellings of one entity stay one. Of a name behind a title each word is an entity of its own,
together with the gender that the title tells: Mr Ivan Petrov and Mr Petrov keep their surname in common. A surrogate
keeps its surface's format: separators, length, letter case, the letters' script, an address's type; names are made of
syllables and end as their gender asks. Digits and letters come from a hash of the key, the type, the canonical form
and an attempt. The key alone decides it, so that an entity has the same surrogate in all documents.

Collision check: candidates of all distinct entities are compared with each other and with all entities. The smallest
canonical form keeps a candidate that several share, the others draw again. What is left after ``ATTEMPTS`` draws has a
format with too few surrogates (names of two letters): from then on they get longer by four characters an attempt, until
each has one of its own. Attempts other than the first are few; as a
literal map they reach the texts without a join, and by a join on the document beyond ``literal`` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm.common import discard, materialise

# Titles by gender, in English, German, French and Spanish; and the patterns.
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra"
MALE = "Mr|Sir|Herr|Monsieur|Señor|Sr"
EMAIL = r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"
PHONE = r"(?<![\p{L}\p{N}])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\p{L}\p{N}])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\p{L}\p{N}.-])\d{3}-\d{3}-\d{4}(?![\p{N}-])"
ADDRESS = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
SSN = r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])"
CARD = r"(?<!\d)\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}(?!\d)|(?<!\d)\d{13,19}(?!\d)"
SECRET = r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])"
NAME = rf"(?<!\p{{L}})(?:{FEMALE}|{MALE})\.? \p{{Lu}}[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+)?"
TYPES = {"email": EMAIL, "secret": SECRET, "ip": ADDRESS, "ssn": SSN, "phone": PHONE, "card": CARD, "name": NAME}
ANY = "|".join(f"(?:{p})" for p in TYPES.values())
LETTERS = {"cyrillic": "бвгджзклмнпрстфх", "greek": "βγδζθκλμνξπρστφχ", "latin": "bcdfghklmnprstvw"}
VOWELS = {"cyrillic": "аеиоу", "greek": "αεηιο", "latin": "aeiou"}  # the first one ends women's names
_GAP = r"[ .()-]*"
#: A number's country code, by its digits and not by what separates them.
COUNTRY = r"^\+" + _GAP + rf"(?:[17]|2{_GAP}[07]|3{_GAP}[0-469]|4{_GAP}[013-9]|5{_GAP}[1-8]|6{_GAP}[0-6]|8{_GAP}[1246]|9{_GAP}[0-58]|\d{_GAP}\d{_GAP}\d)"
TITLE = rf"^(?:{FEMALE}|{MALE})\.? "
ATTEMPTS = 6
LONGER = 16  # further attempts, the last of which adds 64 characters


def mentions_of(text: Column) -> Column:
    """All entities of a text in order. Most texts have no character that any pattern needs, which plain searches find
    far sooner than the pattern would."""
    body = F.coalesce(text.cast("string"), F.lit(""))
    hint = body.contains("@") | body.rlike("[0-9]") | body.rlike("[a-f]{32}")
    for title in f"{FEMALE}|{MALE}".split("|"):
        hint = hint | body.contains(f"{title} ") | body.contains(f"{title}. ")
    return F.when(hint, F.regexp_extract_all(body, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def kind_of(surface: Column) -> Column:
    """Type of an entity: the first whose whole pattern fits."""
    out = F.lit("name")
    for name, pattern in reversed(TYPES.items()):
        out = F.when(surface.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def canonical(kind: Column, surface: Column) -> Column:
    """What spellings of one entity that is no name share: lower case; numbers without separators, a phone's without its
    country code too, which its surrogates keep."""
    low = F.lower(surface)
    digits = F.regexp_replace(low, r"[^\p{N}]", "")
    return F.when(kind == "phone", F.regexp_replace(F.regexp_replace(low, COUNTRY, ""), r"[^\p{N}]", "")).when(kind.isin("ssn", "card"), digits).otherwise(low)


def parts_of(mention: Column) -> Column:
    """Array of a mention's entities: ``lead`` (a title, which stays), surface ``s``, type ``k``, canonical form ``c``."""
    title = F.regexp_extract(mention, TITLE, 0)
    gender = F.when(mention.rlike(rf"^(?:{FEMALE})\.? "), "f:").otherwise("m:")
    words = F.split(F.regexp_replace(mention, TITLE, ""), " ")
    name = F.transform(words, lambda w, i: F.struct(F.when(i == 0, title).otherwise(" ").alias("lead"), w.alias("s"), F.lit("name").alias("k"), F.concat(gender, F.lower(w)).alias("c")))
    typed = F.transform(F.array(F.struct(mention.alias("s"), kind_of(mention).alias("k"))), lambda e: F.struct(F.lit("").alias("lead"), e["s"].alias("s"), e["k"].alias("k"), canonical(e["k"], e["s"]).alias("c")))
    return F.when(title != "", name).otherwise(typed)


def stream_of(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """1,024 hexadecimal digits that belong to an entity and an attempt."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.sha2(F.concat_ws("\x1f", seed, i.cast("string")), 256)), "")


def lengthen(kind: Column, canon: Column, new: Column, attempt: Column, digits: Column, letters: Column) -> Column:
    """The surrogate with further characters from the stream's end if attempts at the format's own length are used up:
    before a woman's name's last letter, before an e-mail, after all others. An address cannot get longer."""
    more = F.greatest(attempt - (ATTEMPTS - 1), F.lit(0)) * 4
    some, numbers = F.substring(letters, F.lit(901), more), F.substring(digits, F.lit(901), more)
    woman = F.concat(F.substring(new, F.lit(1), F.length(new) - 1), some, F.substring(new, -1, 1))
    out = F.when(kind == "email", F.concat(some, new)).when(kind == "name", F.when(canon.startswith("f:"), woman).otherwise(F.concat(new, some))).when(kind.isin("phone", "ssn", "card"), F.concat(new, numbers)).otherwise(new)
    return F.when(more > 0, out).otherwise(new)


def digits_of(stream: Column) -> Column:
    return F.translate(stream, "abcdef", "258147")


def _by_script(surface: Column, of: dict[str, Column]) -> Column:
    return F.when(surface.rlike(r"\p{IsCyrillic}"), of["cyrillic"]).when(surface.rlike(r"\p{IsGreek}"), of["greek"]).otherwise(of["latin"])


def letters_of(kind: Column, stream: Column, surface: Column) -> Column:
    """The stream as letters of the surface's script; for a name, consonants and vowels in turn."""
    out = _by_script(surface, {s: F.translate(stream, "0123456789abcdef", LETTERS[s]) for s in LETTERS})
    soft = _by_script(surface, {s: F.translate(stream, "0123456789abcdef", (VOWELS[s] * 4)[:16]) for s in VOWELS})
    turns = F.array_join(F.zip_with(F.regexp_extract_all(out, F.lit("(?s)..?"), F.lit(0)), F.regexp_extract_all(soft, F.lit("(?s)..?"), F.lit(0)), lambda a, b: F.concat(F.substring(a, 1, 1), F.substring(b, 2, 1))), "")
    return F.when(kind == "name", turns).otherwise(out)


def surrogate(kind: Column, surface: Column, canon: Column, stream: Column, digits: Column, letters: Column) -> Column:
    """The surface with its digits and letters drawn anew; a phone's country code stays, and so do an e-mail's
    separators; an address's parts stay below 255; a woman's name ends in the script's first vowel, a man's in a
    consonant. All but ``kind`` and ``surface`` must be columns or fields, as each character reads them."""
    country = F.when(kind == "phone", F.regexp_extract(surface, COUNTRY, 0)).otherwise("")
    # Each character with its place among letters and digits: separators do not change what is drawn.
    chars = F.split(F.substring(surface, F.length(country) + 1, F.length(surface)), "")
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("n"))

    def draw(done: Column, c: Column) -> Column:
        place, solid = done["n"] % 900 + 1, c.rlike(r"^[\p{L}\p{N}]$")
        new = F.when(~solid, c).when(c.rlike(r"^\p{N}$"), F.substring(digits, place, 1)).when(c.rlike(r"^\p{Lu}$"), F.upper(F.substring(letters, place, 1))).otherwise(F.substring(letters, place, 1))
        return F.struct(F.concat(done["text"], new).alias("text"), (done["n"] + solid.cast("int")).alias("n"))

    drawn = F.aggregate(chars, start, draw, lambda done: done["text"])
    vowel = _by_script(surface, {s: F.lit(v[0]) for s, v in VOWELS.items()})
    last = F.when(canon.startswith("f:"), vowel).otherwise(F.substring(letters, 899, 1))
    last = F.when(surface.rlike(r"\p{Lu}$"), F.upper(last)).otherwise(last)
    name = F.when(F.length(surface) > 1, F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 1), last)).otherwise(drawn)
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.conv(F.substring(stream, i * 4 + 1, 4), 16, 10).cast("int") % 254 + 1).cast("string")), ".")
    mail = F.regexp_replace(drawn, r"\.[^@]*$", ".example.org")
    return F.when(kind == "ip", octets).when(kind == "secret", F.substring(stream, 1, F.length(surface))).when(kind == "email", F.regexp_replace(mail, r"@([^.]+)$", "@$1.example.org")).when(kind == "name", name).otherwise(F.concat(country, drawn))


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct ``(kind, canon, surface)``, the surface being the smallest spelling."""
    found = docs.select(F.explode(F.array_distinct(mentions_of(F.col(text_col)))).alias("m")).select(F.explode(parts_of(F.col("m"))).alias("e"))
    return found.groupBy(F.col("e.k").alias("kind"), F.col("e.c").alias("canon")).agg(F.min("e.s").alias("surface"))


def redraws(found: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
    """``(kind, canon, attempt)`` of the entities whose surrogate is not that of the first attempt."""
    spark = found.sparkSession
    kind, canon, width = F.col("kind"), F.col("canon"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    pending, paths, taken, moved = found, [], None, None
    for attempt in range(ATTEMPTS + LONGER):
        # Few bytes, much work: a fixed number of parts, which are not put together again for their size.
        made = pending.repartition(width, "kind", "canon").withColumn("stream", stream_of(key, kind, canon, F.lit(attempt)))
        made = made.withColumns({"digits": digits_of(F.col("stream")), "letters": letters_of(kind, F.col("stream"), F.col("surface"))})
        made = made.withColumn("new", surrogate(kind, F.col("surface"), canon, F.col("stream"), F.col("digits"), F.col("letters")))
        made = made.withColumn("new", lengthen(kind, canon, F.col("new"), F.lit(attempt), F.col("digits"), F.col("letters")))
        made = made.withColumn("code", F.when(kind == "name", F.concat(F.substring(canon, 1, 2), F.lower("new"))).otherwise(canonical(kind, F.col("new"))))
        real = found.select(F.col("kind").alias("k"), F.col("canon").alias("c"))
        made = made.join(real, (kind == F.col("k")) & (F.col("code") == F.col("c")), "left").withColumn("free", F.col("k").isNull()).drop("k", "c")
        if taken is not None:
            made = made.join(taken.withColumnRenamed("kind", "k"), (kind == F.col("k")) & (F.col("code") == F.col("used")), "left").withColumn("free", F.col("free") & F.col("k").isNull()).drop("k", "used")
        # Who keeps a code: one row per code is summed up before the shuffle, whatever its crowd.
        first = made.where("free").groupBy(F.col("kind").alias("k"), F.col("code").alias("c")).agg(F.min("canon").alias("keeper"))
        made = made.join(first, (kind == F.col("k")) & (F.col("code") == F.col("c")), "left").withColumn("kept", F.col("free") & (canon == F.col("keeper")))
        made, path = materialise(made.select("kind", "canon", "surface", "code", F.coalesce("kept", F.lit(False)).alias("kept")), "surrogates")
        paths.append(path)
        mine = made.where("kept").select("kind", F.col("code").alias("used"))
        taken = mine if taken is None else taken.union(mine)
        settled = made.where("kept").select("kind", "canon", F.lit(attempt).alias("attempt"))
        if attempt:
            moved = settled if moved is None else moved.union(settled)
        pending = made.where("not kept").select("kind", "canon", "surface")
        if pending.isEmpty():
            break
    else:
        raise ValueError("entities are left without a surrogate of their own; their format is too narrow")
    if moved is None:
        moved = spark.createDataFrame([], "kind string, canon string, attempt int")
    out, kept = materialise(moved, "redraws")
    discard(spark, *paths)
    return out, [kept]


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", *, literal: int = 2000) -> DataFrame:
    """The documents with each entity of their texts replaced, and ``n_entities int`` (a name of two words counts once);
    all other columns unchanged.

    Null and empty texts stay as they are, texts may have any length, and repeated rows get the same text. A column
    named ``n_entities`` is replaced; other columns may have any name. Distinct entities have distinct surrogates, none
    of which is an entity of the table. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    found, path = materialise(entities(docs, text_col), "entities")
    moved, _ = redraws(found, key)
    discard(spark, path)
    columns = [c for c in docs.columns if c != "n_entities"]
    body = F.col(f"row.`{text_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    rows = rows.select("row", F.transform(mentions_of(body), parts_of).alias("found"))
    few = moved.limit(literal + 1).collect()
    if len(few) <= literal:
        pairs = [x for r in few for x in (F.lit(f"{r.kind}\x1f{r.canon}"), F.lit(r.attempt))]
        attempts = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,int>")
        rows = rows.withColumn("attempts", attempts)
    else:  # the few documents that hold such an entity get a map of their own, found by a hash of their mentions
        mark = F.xxhash64("found")
        mentions = rows.where(F.size("found") > 0).select(mark.alias("mark"), "found").dropDuplicates(["mark"]).select("mark", F.explode(F.flatten("found")).alias("e"))
        codes = moved.select(F.concat_ws("\x1f", "kind", "canon").alias("code"), "attempt")
        mentions = mentions.select("mark", F.concat_ws("\x1f", "e.k", "e.c").alias("code")).distinct().join(codes, "code")
        maps = mentions.groupBy("mark").agg(F.map_from_entries(F.collect_list(F.struct("code", "attempt"))).alias("attempts"))
        rows = rows.withColumn("mark", mark).join(maps, "mark", "left").drop("mark")

    attempt_of = lambda e: F.coalesce(F.try_element_at(F.col("attempts"), F.concat_ws("\x1f", e["k"], e["c"])), F.lit(0))
    keep = lambda e, *names: [e[n].alias(n) for n in names]
    # Step by step, each on fields of the one before: a lambda would compute an expression again wherever it is named.
    steps = [
        lambda e: F.struct(*keep(e, "lead", "s", "k", "c"), attempt_of(e).alias("a")),
        lambda e: F.struct(*keep(e, "lead", "s", "k", "c", "a"), stream_of(key, e["k"], e["c"], e["a"]).alias("h")),
        lambda e: F.struct(*keep(e, "lead", "s", "k", "c", "a", "h"), digits_of(e["h"]).alias("d"), letters_of(e["k"], e["h"], e["s"]).alias("l")),
        lambda e: F.struct(*keep(e, "lead", "k", "c", "a", "d", "l"), surrogate(e["k"], e["s"], e["c"], e["h"], e["d"], e["l"]).alias("n")),
        lambda e: F.concat(e["lead"], lengthen(e["k"], e["c"], e["n"], e["a"], e["d"], e["l"])),
    ]
    new = F.flatten("found")
    for step in steps:
        new = F.transform(new, step)
    rows = rows.select("row", "found", new.alias("new"))
    # Of each mention where its parts end among all parts; then the gaps between mentions with the mentions' new parts.
    ends = F.aggregate("found", F.array(F.lit(0)), lambda done, m: F.concat(done, F.array(F.element_at(done, -1) + F.size(m))))
    rows = rows.select("row", "new", F.size("found").alias("n"), ends.alias("ends"), F.split(body, ANY).alias("gaps"))
    joined = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat(F.element_at("gaps", i), F.array_join(F.slice("new", F.element_at("ends", i) + 1, F.element_at("ends", i + 1) - F.element_at("ends", i)), "")))
    rebuilt = F.concat(F.array_join(joined, ""), F.element_at("gaps", -1))
    text = F.when(F.col("n") > 0, rebuilt).otherwise(body).alias(text_col)
    return rows.select(*[text if c == text_col else F.col(f"row.`{c}`").alias(c) for c in columns], F.col("n").alias("n_entities"))
