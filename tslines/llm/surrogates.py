"""Surrogates for personal data: keyed, of the same type and format, and distinct.

Found are mail addresses, phone numbers, IPv4 addresses, card and account
numbers, social security numbers, long keys in hexadecimal, and names after a
title. Each distinct value gets one surrogate drawn from a hash of the secret
key, its type, the value and a try number, so a value is replaced alike in all
documents:

* digits become digits, letters letters of the same case and script, and
  punctuation stays; what marks the format is kept (a phone number's country
  code, a card's first digit and its Luhn remainder, two letters of an IBAN);
* mail goes to a domain that is reserved for examples, IP addresses to a block
  that no host has;
* first names are built with an ending of the gender that the title tells, in
  the script of the original (Latin, Cyrillic or Greek); a name is replaced
  part by part, so "Mrs. Ann Smith" and "Mrs. Smith" keep their surname in common.

Collision check: a surrogate must equal no real value of the corpus and no
surrogate of another value. Of the values that draw the same one the smallest
keeps it; the others draw again until all are distinct.

Everything is DataFrame functions. Values are made distinct before anything is
joined, and a frequent value only meets its one surrogate, in a join whose
large keys are split.

Defined cases: null texts stay null with 0 entities; rows without an id are
treated like others; repeated rows get equal results; an empty table stays
empty. Values that were already surrogates are replaced again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.llm import common

KEY = "surrogate-key"
#: Draws before the job gives up; each one leaves far fewer values than the one before.
TRIES = 40
#: Replacements are broadcast up to this size; beyond, the join shuffles.
BROADCAST_BYTES = 32 << 20

# Formats, titles, name parts.
MAIL = (r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)++\p{L}{2,24}")
IP = (r"(?<!\w)(?<!\d\.)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)")
#: No group of a phone number begins an IP address, so none is cut.
PHONE = (rf"(?<![\w+(])(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)|(?!{IP})\d{{2,4}})[ .-](?!{IP})\d{{3,4}}"
         rf"[ .-](?!{IP})\d{{3,4}}(?![\w])")
CARD = r"(?<![\w])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19})(?!\w)"
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)"
SECRET = r"(?<!\w)(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,128}(?!\w)"
MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "κυρία")
NAME = r"\p{Lu}\p{L}+(?:[-'’]\p{Lu}\p{L}+)*"
PERSON = rf"(?<!\w)(?:{'|'.join(MALE + FEMALE)})\.?[ ]{NAME}(?:[ ]{NAME})?"
PATTERN = "|".join((MAIL, SECRET, IBAN, SOCIAL, CARD, IP, PHONE, PERSON))
#: No entity is in a text without one of these.
HINT = rf"\d{{1,3}}[.( -]|\d{{4}}|@|[0-9a-fA-F]{{32}}|(?<!\w)(?:{'|'.join(MALE + FEMALE)})[. ]"
SYLLABLES = {
    "latin": "ba be bo da de do fa fe fi ga go ka ke ki la le li lo ma me mi mo na ne ni no pa pe "
             "ra re ri ro sa se si so ta te ti to va ve vi".split(),
    "cyrillic": "ба бо да де до ка ки ко ла ли ло ма ми мо на не но па по ра ри ро са се со та ти "
                "то ва ви".split(),
    "greek": "βα βο δα δο κα κι λα λι λο μα μι νο να πα πο ρα ρι ρο σα σο τα τι".split(),
}
ENDINGS = {"latin": {"m": ["n", "rd", "ston"], "f": ["na", "lia", "rine"], "l": ["ner", "well", "mont"]},
           "cyrillic": {"m": ["н", "слав", "р"], "f": ["на", "лия", "ра"], "l": ["ков", "нко", "ский"]},
           "greek": {"m": ["νος", "ρης"], "f": ["να", "ρία"], "l": ["ίδης", "άκης"]}}


def _one_of(items: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), (F.pmod(number, F.lit(len(items))) + 1).cast("int"))


def _draw(*what) -> Column:
    """A number from the hash of the value's draw; `what` tells its draws apart."""
    return F.xxhash64("draw", *[F.lit(w) if not isinstance(w, Column) else w for w in what])


def _same_format(text: Column, keep: int = 0) -> Column:
    """Digits and letters drawn anew in their own class; the first `keep` characters stay."""
    def one(c, i):
        n = _draw("char", i)
        of = lambda first, size: F.chr(F.lit(ord(first)) + F.pmod(n, F.lit(size)))
        wide = lambda letters: _one_of(list(letters), n)
        return (F.when(i < keep, c)
                .when(c.between("0", "9"), of("0", 10)).when(c.between("a", "z"), of("a", 26))
                .when(c.between("A", "Z"), of("A", 26))
                .when(c.between("а", "я"), wide("авеиклмнорст")).when(c.between("А", "Я"), wide("АВЕИКЛМНОРСТ"))
                .when(c.between("α", "ω"), wide("αβγδεικλμνο")).when(c.between("Α", "Ω"), wide("ΑΒΓΔΕΙΚΛΜΝΟ"))
                .when(c.rlike(r"\p{Ll}"), of("a", 26)).when(c.rlike(r"\p{Lu}"), of("A", 26)).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(text: Column) -> Column:
    """The Luhn sum of a number's digits, modulo 10."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(text, r"\D", "")), ""), lambda d: d.cast("int"))
    twice = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(twice, F.lit(0), lambda a, d: a + d) % 10


def _card(value: Column) -> Column:
    drawn = _same_format(value, 1)
    last = F.pmod(F.right(drawn, F.lit(1)).cast("int") + _luhn(value) - _luhn(drawn), F.lit(10))
    return F.concat(F.left(drawn, F.length(drawn) - 1), last.cast("string"))


def _secret(value: Column) -> Column:
    """Hexadecimal in the case of the value; in mixed case each place keeps its own."""
    drawn = F.substr(F.sha2("draw", 512), F.lit(1), F.length(value))
    mixed = F.array_join(F.zip_with(F.split(drawn, ""), F.split(value, ""),
                                    lambda d, c: F.when(c == F.lower(c), d).otherwise(F.upper(d))), "")
    return (F.when(value == F.lower(value), drawn).when(value == F.upper(value), F.upper(drawn))
            .otherwise(mixed))


def _name(value: Column, gender: Column, tries: Column) -> Column:
    """A name of drawn syllables; each further try may take one more."""
    def build(script):
        one = F.transform(F.sequence(F.lit(1), F.lit(2) + F.least(tries, F.lit(4))),
                          lambda i: _one_of(SYLLABLES[script], _draw("syllable", i)))
        ends = ENDINGS[script]
        end = (F.when(gender == "first m", _one_of(ends["m"], _draw("end")))
               .when(gender == "first f", _one_of(ends["f"], _draw("end")))
               .otherwise(_one_of(ends["l"], _draw("end"))))
        return F.initcap(F.concat(F.array_join(one, ""), end))
    made = (F.when(value.rlike(r"^\p{IsCyrillic}"), build("cyrillic"))
            .when(value.rlike(r"^\p{IsGreek}"), build("greek")).otherwise(build("latin")))
    return F.when((value == F.upper(value)) & (F.length(value) > 1), F.upper(made)).otherwise(made)


def _surrogate(kind: Column, value: Column, tries: Column) -> Column:
    """One draw for a value of a type."""
    local = F.split_part(value, F.lit("@"), F.lit(1))
    octet = lambda n, low, size: (F.lit(low) + F.pmod(_draw("octet", n), F.lit(size))).cast("string")
    domain = _one_of(["example.com", "example.org", "example.net"], _draw("domain"))
    mail = F.concat(_same_format(local), F.lit("@mail"), F.pmod(_draw("host"), F.lit(1000)).cast("string"),
                    F.lit("."), domain)
    ip = F.concat_ws(".", octet(1, 240, 15), octet(2, 0, 256), octet(3, 0, 256), octet(4, 1, 254))
    code = F.length(F.regexp_extract(value, r"^\+\d{1,3}(?=[ .-])", 0))
    phone = F.concat(F.left(value, code), _same_format(F.substr(value, code + 1)))
    return (F.when(kind == "mail", mail).when(kind == "ip", ip).when(kind == "phone", phone)
            .when(kind == "card", _card(value)).when(kind == "iban", _same_format(value, 2))
            .when(kind == "secret", _secret(value))
            .when(kind == "social", _same_format(value))
            .otherwise(_name(value, kind, tries)))


def _kind(value: Column) -> Column:
    full = lambda p: value.rlike(f"^(?:{p})$")
    return (F.when(value.contains("@"), "mail").when(full(SECRET), "secret").when(full(IBAN), "iban")
            .when(full(SOCIAL), "social").when(full(CARD), "card").when(full(IP), "ip")
            .when(full(PERSON), "person").otherwise("phone"))


def assign(values: DataFrame, key: str = KEY, tries: int = TRIES) -> DataFrame:
    """(kind, value, surrogate) for distinct rows (kind, value), all surrogates distinct."""
    todo, given = values, None
    for n in range(tries):
        drawn = todo.withColumn("draw", F.sha2(F.concat_ws("\u0001", F.lit(key), "kind", "value", F.lit(n)), 256))
        drawn = drawn.withColumn("surrogate", _surrogate(F.col("kind"), F.col("value"), F.lit(n))).drop("draw")
        taken = values.select(F.col("value").alias("surrogate"))
        if given is not None:
            taken = taken.unionByName(given.select("surrogate"))
        free = drawn.join(taken, "surrogate", "left_anti")
        won = free.groupBy("surrogate").agg(F.min(F.struct("kind", "value")).alias("_w"))
        won = common.stage(won.select("_w.kind", "_w.value", "surrogate"), "surrogates")
        given = won if given is None else given.unionByName(won)
        todo = common.stage(todo.join(won, ["kind", "value"], "left_anti"), "again")
        if todo.isEmpty():
            return given
    raise RuntimeError(f"no distinct surrogates after {tries} draws")


def _persons(values: DataFrame) -> DataFrame:
    """Title, first name and surname of the values that are persons."""
    title = F.regexp_extract("value", r"^(\p{L}+\.?) ", 1)
    names = F.split(F.substr(F.col("value"), F.length(title) + 2), " ")
    male = F.regexp_replace(title, r"\.$", "").isin(*MALE)
    return (values.where("kind = 'person'").select("value", title.alias("title"), names.alias("names"))
            .select("value", "title",
                    F.when(F.size("names") > 1, F.element_at("names", 1)).alias("first"),
                    F.element_at("names", -1).alias("last"),
                    F.when(male, "first m").otherwise("first f").alias("gender")))


def _part(kind: Column, value: Column) -> Column:
    return F.struct(kind.alias("kind"), value.alias("value"))


def replacements(values: DataFrame, key: str = KEY) -> DataFrame:
    """(value, surrogate) for distinct values that PATTERN matches."""
    values = common.stage(values.select("value", _kind(F.col("value")).alias("kind")), "values")
    people = _persons(values)
    parts = people.select(F.explode(F.array(
        _part(F.col("gender"), F.col("first")), _part(F.lit("last"), F.col("last")))).alias("p"))
    parts = parts.select("p.*").where("value is not null")
    plain = values.where("kind <> 'person'").select("kind", "value")
    found = assign(common.stage(plain.unionByName(parts).distinct(), "parts"), key)
    of = lambda name: found.select(F.col("kind").alias(f"_k{name}"), F.col("value").alias(f"_v{name}"),
                                   F.col("surrogate").alias(f"_s{name}"))
    named = (people.join(of(1), (F.col("gender") == F.col("_k1")) & (F.col("first") == F.col("_v1")), "left")
             .join(of(2), (F.col("_k2") == "last") & (F.col("last") == F.col("_v2")))
             .select("value", F.concat_ws(" ", "title", "_s1", "_s2").alias("surrogate")))
    return found.where(~F.col("kind").isin("first m", "first f", "last")).select(
        "value", "surrogate").unionByName(named)


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, n_entities, entities (value's surrogates in order) and the replaced text."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tag"))
    found = F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    held = common.stage(rows.select("doc_id", "tag", found.alias("found")).where("size(found) > 0"), "found")
    each = held.select("doc_id", "tag", F.explode(F.array_distinct("found")).alias("value")).distinct()
    made = common.stage(replacements(each.select("value").distinct(), key), "replacements")
    maps = each.join(made, "value").groupBy("doc_id", "tag").agg(
        F.map_from_entries(F.collect_list(F.struct("value", "surrogate"))).alias("made"))
    maps = common.stage(maps.withColumnsRenamed({"doc_id": "_doc", "tag": "_tag"}), "maps")
    size = maps.agg(F.sum(F.length(F.to_json("made")) * 2 + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        maps = F.broadcast(maps)
    rows = rows.join(maps, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("tag") == F.col("_tag")), "left")
    new = F.transform(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)), lambda v: F.element_at("made", v))
    gaps = F.split("text", PATTERN, -1)
    joined = F.array_join(F.zip_with(gaps, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    some = F.col("made").isNotNull()
    return rows.select(
        "doc_id", F.when(some, F.size(new)).otherwise(0).alias("n_entities"),
        F.when(some, F.array_join(new, " | ")).otherwise("").alias("surrogates"),
        F.when(some, joined).otherwise(F.col("text")).alias("text"))


def op1_keyed_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(common.table(spark, sf_dir, "documents"))
