"""Personal data replaced by surrogates of the same kind. DataFrame functions only.

Entities are found by patterns and reduced to a normal form, so that spellings of one entity share a surrogate. A surrogate
is made from a keyed hash of the normal form; it keeps lengths, kinds of characters, separators, case, script and the
gender of a title. Surrogates that meet each other or a real entity are made again with the next attempt number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.session import stage

# Titles by gender.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Sir", "Господин", "Г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "Г-жа")
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}"
PHONE = r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9A-Za-z])|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9A-Za-z])"
ADDRESS = r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])"
NUMBER = r"(?<![0-9A-Za-z])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z.=])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|\.[0-9])"
# Without country code or brackets: groups of 3, 3 and 4 digits; or a leading zero, an area code, and groups of 8 digits or more in all.
PLAIN = (r"(?<![0-9A-Za-z+=])(?<![0-9][.,/-])(?:[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|0[0-9](?:[ .-][0-9]{2}){4}"
         r"|(?=(?:[ ./-]?[0-9]){8})0[0-9]{2,4}[ ./-][0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3})(?![0-9A-Za-z]|[.,/-][0-9])")
_TITLES = "|".join(sorted(MALE + FEMALE, key=len, reverse=True))
PERSON = rf"(?<!\p{{L}})(?:{_TITLES})\.? \p{{Lu}}[\p{{L}}'-]++(?: \p{{Lu}}[\p{{L}}'-]++)?"
ENTITY = "|".join((EMAIL, PHONE, ADDRESS, NUMBER, CARD, PLAIN, PERSON))
LATIN = ("ba", "co", "da", "fe", "ga", "hi", "jo", "ka", "le", "mi", "no", "pe", "ri", "so", "tu", "va")
CYRILLIC = ("ба", "ко", "да", "фе", "га", "хи", "жо", "ка", "ле", "ми", "но", "пе", "ри", "со", "ту", "ва")
STREAM = 4  # digests of 32 bytes each; longer forms use them again


def kind_of(found: Column) -> Column:
    return (
        F.when(F.contains(found, F.lit("@")), "email")
        .when(F.rlike(found, F.lit(r"^\p{L}")), "person")
        .when(F.rlike(found, F.lit(r"^[0-9]+(?:\.[0-9]+){3}$")), "address")
        .when(F.rlike(found, F.lit(rf"^(?:{NUMBER})$")), "number")
        .when(F.rlike(found, F.lit(r"^[+(]")), "phone")
        .when(F.rlike(found, F.lit(rf"^(?:{CARD})$")), "card")
        .otherwise("phone")
    )


def normal_form(kind: Column, found: Column) -> Column:
    """Digits of numbers, the lower-cased rest of others. A person's title is reduced to its gender."""
    title = F.regexp_extract(found, rf"^({_TITLES})\.? ", 1)
    gender = F.when(title.isin(*MALE), "m").otherwise("f")
    name = F.lower(F.regexp_replace(found, rf"^(?:{_TITLES})\.? ", ""))
    return (
        F.when(kind.isin("phone", "card", "number"), F.regexp_replace(found, "[^0-9]", ""))
        .when(kind == "person", F.concat(gender, F.lit(":"), name))
        .otherwise(F.lower(found))
    )


def keyed_digest(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """Hexadecimal digits that only the key's holder can make again."""
    inner = lambda k: F.sha2(F.concat_ws("\x00", F.lit(key), kind, norm, attempt.cast("string"), F.lit(str(k))), 256)
    return F.concat(*(F.sha2(F.concat(F.lit(key + "\x01"), inner(k)), 256) for k in range(STREAM)))


def surrogate(kind: Column, norm: Column, digest: Column, attempt: int = 0) -> Column:
    """The replacement of a normal form, itself in normal form, from a column of keyed digits.

    Names get a syllable more every second attempt, and after eight attempts mail addresses a letter and phone numbers a
    digit, so that there are always more surrogates than entities.
    """
    more = max(0, attempt - 6) // 2
    at = lambda i: F.conv(F.substring(digest, F.pmod(i, F.lit(32 * STREAM)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
    letter = lambda i: F.char(F.lit(97) + at(i) % 26)
    digit = lambda i: (at(i) % 10).cast("string")
    size = F.length(norm)

    def spelled(text: Column, offset: int = 0) -> Column:
        one = lambda i: F.substring(text, i, F.lit(1))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: (
            F.when(F.rlike(one(i), F.lit("[0-9]")), digit(i + offset)).when(F.rlike(one(i), F.lit("[a-z]")), letter(i + offset)).otherwise(one(i)))), "")

    # The last label of an address stays, so that it is still a domain.
    tail = F.regexp_extract(norm, r"\.[a-z]+$", 0)
    email = F.concat(spelled(F.substring(norm, F.lit(1), size - F.length(tail))), *(letter(F.lit(64 + p)) for p in range(more)), tail)
    # Country codes and card networks are read from the first digit, which stays. Cards keep a valid check digit.
    digits = F.concat(F.substring(norm, 1, 1), F.array_join(F.transform(F.sequence(F.lit(2), F.greatest(size, F.lit(2))), digit), ""))
    phone = F.concat(digits, *(digit(F.lit(64 + p)) for p in range(more)))
    body = F.substring(digits, F.lit(1), size - 1)

    def weighed(i: Column) -> Column:
        d = F.substring(body, i, F.lit(1)).cast("int")
        return F.when((size - i) % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), F.lit(0), lambda s, i: s + weighed(i))
    card = F.concat(body, F.pmod(-total, F.lit(10)).cast("string"))
    address = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (at(i) % 254 + 1).cast("string")), ".")
    cyrillic = F.rlike(norm, F.lit(r"\p{IsCyrillic}"))

    def name(first: int, parts: int) -> Column:
        make = lambda pool: F.concat(*(F.get(F.array(*map(F.lit, pool)), at(F.lit(first + p)) % len(pool)) for p in range(parts)))
        return F.when(cyrillic, make(CYRILLIC)).otherwise(make(LATIN))

    female = F.startswith(norm, F.lit("f:"))
    ending = F.when(cyrillic, F.when(female, "на").otherwise("н")).otherwise(F.when(female, "na").otherwise("n"))
    person = F.concat(F.substring(norm, 1, 2), name(0, 3 + attempt // 2), ending,
                      F.when(F.contains(norm, F.lit(" ")), F.concat(F.lit(" "), name(8, 4))).otherwise(""))
    return (
        F.when(kind == "email", email).when(kind == "card", card).when(kind == "address", address)
        .when(kind == "person", person).when(kind == "phone", phone).otherwise(digits)
    )


def dressed(kind: Column, found: Column, other: Column) -> Column:
    """A surrogate in the spelling of one occurrence: its separators, title and case."""
    gaps = F.split(found, "[0-9]", -1)
    numbers = F.concat(F.get(gaps, F.lit(0)), F.array_join(F.transform(F.sequence(F.lit(1), F.length(other)), lambda i: F.concat(
        F.substring(other, i, F.lit(1)), F.coalesce(F.get(gaps, i), F.lit("")))), ""))
    cased = F.array_join(F.transform(F.sequence(F.lit(1), F.length(other)), lambda i: F.when(
        F.rlike(F.substring(found, i, F.lit(1)), F.lit("[A-Z]")), F.upper(F.substring(other, i, F.lit(1)))).otherwise(F.substring(other, i, F.lit(1)))), "")
    title = F.regexp_extract(found, rf"^(?:{_TITLES})\.? ", 0)
    bare = F.substring(other, F.lit(3), F.length(other))
    name = F.when(F.rlike(found, F.lit(r"\p{Ll}[^ ]*$")), F.initcap(bare)).otherwise(F.upper(bare))
    return (
        F.when(kind.isin("phone", "card", "number"), numbers).when(kind == "person", F.concat(title, name))
        .when(kind == "email", cased).otherwise(other)
    )


def surrogate_table(entities: DataFrame, key: str, rounds: int = 40) -> DataFrame:
    """Columns kind, norm, other for distinct entities: no two share a surrogate, and none is a real entity's form.

    Of entities that ask for one surrogate the first gets it; the rest try again with the next attempt number, as do those
    that hit a real entity or a surrogate given before. Rounds shrink fast: each handles only the collisions of the last, and
    later attempts choose among more surrogates.
    """
    open_, given = entities, None
    for attempt in range(rounds):
        # The digest is a column of its own, so that the many uses in the surrogate read it instead of making it.
        keyed = open_.withColumn("digest", keyed_digest(F.col("kind"), F.col("norm"), F.lit(attempt), key))
        wanted = keyed.withColumn("other", surrogate(F.col("kind"), F.col("norm"), F.col("digest"), attempt)).drop("digest")
        real = entities.select("kind", F.col("norm").alias("other"))
        free = wanted.join(real, ["kind", "other"], "left_anti")
        if given is not None:
            free = free.join(given.select("kind", "other"), ["kind", "other"], "left_anti")
        won = stage(free.groupBy("kind", "other").agg(F.min("norm").alias("norm")).select("kind", "norm", "other"))
        given = won if given is None else given.unionByName(won)
        open_ = stage(open_.join(won.select("kind", "norm"), ["kind", "norm"], "left_anti"))
        if open_.isEmpty():
            return given
    raise RuntimeError(f"{rounds} attempts did not give every entity a surrogate of its own")


def replace_personal_data(docs: DataFrame, key: str = "surrogate key", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, text with surrogates, n_entities.

    Finds e-mail addresses, phone numbers (with a country code, a bracketed area code, a leading zero, or as 3-3-4 digits with
    separators; digits without any separator are not taken for one), IPv4 addresses, card numbers, numbers like 123-45-6789, and names after a title.
    Equal entities get equal surrogates in all documents and spellings; different ones of a kind get different ones. Null texts
    stay null with 0 entities. Rows without an id and repeated rows are treated like any other. An empty table gives an
    empty result. Texts of any length work; a text's entities are gathered in one row, as its text is.
    """
    every = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    mark = F.xxhash64("id", "text", F.length("text"))
    hits = every.select(mark.alias("mark"), F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)).alias("hits")).where(F.size("hits") > 0)
    each = hits.select("mark", F.posexplode("hits").alias("place", "found")).withColumn("kind", kind_of(F.col("found")))
    each = stage(each.withColumn("norm", normal_form(F.col("kind"), F.col("found"))))
    entities = stage(each.select("kind", "norm").distinct())
    table = surrogate_table(entities, key)
    pairs = each.join(table, ["kind", "norm"]).select(
        "mark", F.struct("place", "found", dressed(F.col("kind"), F.col("found"), F.col("other")).alias("shown")).alias("hit"))
    # Repeated rows give equal hits, which a set holds once.
    swaps = pairs.groupBy("mark").agg(F.sort_array(F.collect_set("hit")).alias("swaps"))
    joined = every.withColumn("mark", mark).join(swaps, "mark", "left")
    gaps = F.split("text", ENTITY, -1)
    shown = F.transform("swaps", lambda s: s["shown"])
    rebuilt = F.array_join(F.zip_with(gaps, F.concat(shown, F.array(F.lit(""))), lambda g, s: F.concat(g, s)), "")
    return joined.select(
        F.col("id").alias(id_col), F.when(F.col("swaps").isNull(), F.col("text")).otherwise(rebuilt).alias(text_col),
        F.when(F.col("swaps").isNull(), 0).otherwise(F.size("swaps")).cast("long").alias("n_entities"))
