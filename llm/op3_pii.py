"""Personal data replaced by keyed surrogates.

Entities (e-mail addresses, phone, card, account and national numbers, IP addresses, secrets, and
names behind a title) are found by one pattern over the whole text. Each gets a surrogate of its
own type: letters stay letters of their case and script, digits digits, separators stay, IP octets
stay below 256 (an IPv6 address is written in full), an address keeps its top domain, a phone number its country code, a card its first
digit, an account its country, a name its title, and a woman's or man's name gets one of that kind.
The surrogate is a keyed hash (SHA-256) of what the entity is, not how it is written, so one entity gets
one surrogate everywhere, in any format or case, and a family name the same one with and without
the first name. A distributed check over all distinct entities finds those that share a surrogate
or whose surrogate is itself an entity of the corpus; these are hashed again until none is left, into
longer surrogates where those of the same form may not suffice, so different entities stay different.
DataFrame functions only.

Defined results: null text stays null, empty text empty; texts without entities stay as they are to
the character; rows that repeat get the same text; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from llm.common import saved, table

KEY = "corpus"

_L, _LN = r"\p{L}", r"\p{L}\p{N}"
_H = "[0-9A-Fa-f]{1,4}"
_TITLES = r"(?:Mr\.?|Mrs\.?|Ms\.?|Miss|Dr\.?|Prof\.?|Herr|Frau|Mme|Mlle|Madame|Monsieur|Sr\.|Sra\.|Señor|Señora|Г-н|Г-жа) "
#: In the order in which they are tried at a place. Possessive and anchored, so a text is read once.
PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", rf"(?<![{_LN}._%+\-])[{_LN}._%+\-]++@[{_LN}\-]++(?:\.[{_LN}\-]++)+"),
    ("secret", r"(?<=(?i:token|secret|password|passwd|api_key|api-key|apikey|access_key)\s{0,3}[=:]\s{0,3}[\"']?)(?=[+/_\-]*[A-Za-z0-9])[A-Za-z0-9+/_\-]{16,}+"),
    ("secret", r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]*[A-Fa-f])(?=[0-9A-Fa-f]*[0-9])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![A-Za-z0-9])"),
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ip", rf"(?<![0-9A-Za-z.])(?<![0-9:]:)(?=[0-9A-Fa-f]{{1,4}}:)(?:(?:{_H}:){{7}}{_H}|(?=[A-Fa-f:]*[0-9])[0-9A-Fa-f]{{4}}(?::{_H}){{0,6}}::"
           rf"(?:{_H}(?::{_H}){{0,6}})?)(?![0-9A-Za-z]|:[0-9A-Fa-f:]|\.[0-9])"),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("card", r"(?<![0-9.,\-])(?:[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{1,7}|[0-9]{4}[ \-]?[0-9]{6}[ \-]?[0-9]{5})(?![0-9])"),
    ("national", r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"),
    ("phone", r"(?<![0-9+])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{1,4}\)[ .\-]?|[0-9]{2,4}[ .\-])[0-9]{3,4}[ .\-][0-9]{3,4}(?![0-9])"),
    ("phone", r"(?<![0-9+])\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){2,5}(?![0-9])"),
    ("phone", r"(?<![0-9+])\+[0-9](?:[ .\-/()]{0,2}[0-9]){7,14}(?![0-9])"),
    ("phone", r"(?<![0-9+.,/\-])\(0[0-9]{1,5}\)[ .\-/]?[0-9]{3,9}(?:[ \-][0-9]{2,5}){0,3}(?![0-9])"),
    ("phone", r"(?<![0-9+.,/\-])\([0-9]{3}\)[ .\-/]?[0-9]{7}(?![0-9])"),
    ("phone", r"(?<![0-9+.,/\-])(?<![0-9][ .\-])0[1-9](?:[ .\-][0-9]{2}){4}(?![ .\-]?[0-9])"),
    ("phone", r"(?<![0-9+.,/\-])0[1-9][0-9]{1,4}[ \-/][0-9]{5,9}(?:[ \-][0-9]{1,5})?(?![0-9])"),
    ("name", rf"(?<![{_LN}])(?:{_TITLES})+\p{{Lu}}[{_L}'’\-]++(?: \p{{Lu}}[{_L}'’\-]++)?"),
)
ANY = "|".join(f"(?:{p})" for _, p in PATTERNS)
#: Titles before names, as they stand in texts; what begins a name pattern.
TITLES = ("Mr", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Mme", "Mlle", "Madame", "Monsieur", "Sr.", "Sra.", "Señor", "Г-")
FEMALE = r"^(?:Mrs|Ms|Miss|Frau|Mme|Mlle|Madame|Sra|Señora|Г-жа)"
TITLE = rf"^(?:{_TITLES})+"

#: Stand-ins by a hash character 0-f: letters of words that are no words, and digits.
LATIN, CYRILLIC, GREEK, DIGITS = "bcdfghjklmnprstv", "бвгджзклмнпрстфх", "βγδζθκλμνξπρστφχ", "0123456789012345"
VOWELS = {"latin": "aeiouaeiouaeioua", "cyrillic": "аеиоуаеиоуаеиоуа", "greek": "αειουαειουαειουα"}
HEX = "0123456789abcdef"
#: Country codes of the international numbering plan; no code begins another one.
COUNTRY_CODE = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Every further turn adds a letter to a name, and a letter or digit to other types after so many turns; IP addresses cannot grow.
SAME_FORM, MOST_TURNS = 1, 200


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out and written into the plan once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def may_hold(text: Column) -> Column:
    """False only for texts without any entity; much cheaper to tell than the pattern."""
    named = F.lit(False)
    for t in TITLES:
        named = named | F.contains(text, F.lit(t))
    assigned = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    access_key = F.contains(text, F.lit("AKIA")) | F.contains(text, F.lit("ASIA"))
    return F.coalesce(text.rlike("[0-9@]") | named | assigned | access_key, F.lit(False))


def kind(entity: Column) -> Column:
    """Type of a matched entity: the first pattern that fits it alone."""
    out = F.when(entity.contains("@"), "email")
    out = out.when(entity.rlike(TITLE + r"\p{Lu}") & ~entity.rlike("[0-9]"), "name")
    for name, p in PATTERNS:
        if name in ("iban", "ip", "card", "national"):
            out = out.when(entity.rlike(f"^(?:{p})$"), name)
    return out.when(entity.rlike(r"^(?:\+[0-9]|[0-9(])[0-9 .()/\-]*$"), "phone").otherwise("secret")


def parts(entity: Column, of: Column) -> Column:
    """What is replaced and checked on its own: the words of a name, anything else as a whole."""
    return F.when(of == "name", F.split(F.regexp_replace(entity, TITLE, ""), " ")).otherwise(F.array(entity))


def norm(part: Column, of: Column) -> Column:
    """What a part is, however written: its letters and digits, lower case.

    An IP address keeps its dots, or has all eight groups of four; a phone number keeps the plus before
    its country code.
    """
    def groups(halves: Column) -> Column:
        left, right = (F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda x: x != "") for i in (0, 1))
        zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right)))
        return F.array_join(F.transform(F.concat(left, zeros, right), lambda x: F.lpad(x, 4, "0")), ":")

    return (F.when((of == "ip") & part.contains(":"), _let(F.split(F.lower(part), "::"), groups)).when(of == "ip", part)
            .when(of == "phone", F.regexp_replace(part, "[^0-9+]", ""))
            .otherwise(F.lower(F.regexp_replace(part, rf"[^{_LN}]", ""))))


def gender(entity: Column, of: Column) -> Column:
    return F.when(of != "name", "").when(entity.rlike(FEMALE), "f").otherwise("m")


def _char(c: Column, h: Column, vowel: Column) -> Column:
    """Stand-in of one letter or digit: of its class, case and script."""
    low = F.when(c.rlike(r"\p{IsCyrillic}"), F.when(vowel, F.translate(h, HEX, VOWELS["cyrillic"])).otherwise(F.translate(h, HEX, CYRILLIC)))
    low = low.when(c.rlike(r"\p{IsGreek}"), F.when(vowel, F.translate(h, HEX, VOWELS["greek"])).otherwise(F.translate(h, HEX, GREEK)))
    low = low.when(vowel, F.translate(h, HEX, VOWELS["latin"])).otherwise(F.translate(h, HEX, LATIN))
    return (F.when(c.rlike("[0-9]"), F.translate(h, HEX, DIGITS)).when(c.rlike(r"\p{Lu}"), F.upper(low))
            .when(c.rlike(rf"[{_LN}]"), low).otherwise(c))


def surrogate(part: Column, of: Column, female: Column, turn: Column, key: str = KEY) -> Column:
    """The stand-in of a part; ``turn`` counts how often it was hashed again."""
    def hashed(name: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), of, name, turn.cast("string"))
        digest = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("|2")), 256))
        return _let(digest, lambda d: _stand_in(part, of, female, turn, name, seed, d))

    return _let(norm(part, of), hashed)


def _stand_in(part: Column, of: Column, female: Column, turn: Column, name: Column, seed: Column, digest: Column) -> Column:
    # left as they are: country code of a phone, top domain, country of an account, first digit of a card
    fixed_head = (F.when(of == "phone", F.length(F.regexp_extract(name, COUNTRY_CODE, 0)) - 1)
                  .when(of == "iban", 2).when(of == "card", 1).otherwise(0))
    fixed_tail = F.when(of == "email", F.length(F.regexp_extract(part, r"\.[^.@]*$", 0))).otherwise(0)

    def stand_in(i: Column, kept: Column) -> Column:
        c = F.substring(part, i, F.lit(1))
        k = F.length(F.regexp_replace(F.substring(part, F.lit(1), i), rf"[^{_LN}]", ""))  # which letter or digit it is
        h = F.substring(digest, F.pmod(k - 1, F.lit(128)) + 1, F.lit(1))
        vowel = (of == "name") & (k % 2 == 0)
        hexed = (of == "secret") & name.rlike("^[0-9a-f]+$")
        plain = F.when(hexed, F.when(c.rlike("[A-F]"), F.upper(h)).otherwise(h)).otherwise(_char(c, h, vowel))
        return F.when((k <= kept["head"]) | (i > F.length(part) - kept["tail"]), c).otherwise(plain)

    written = _let(F.struct(fixed_head.alias("head"), fixed_tail.alias("tail")), lambda kept: F.array_join(
        F.transform(F.sequence(F.lit(1), F.length(part)), lambda i: stand_in(i, kept)), ""))
    # letters or digits more than the original has, so that later turns choose from ever more surrogates
    extra = F.when(of == "name", turn).when(of == "ip", 0).otherwise(F.greatest(F.lit(0), turn - SAME_FORM))
    spare = F.sha2(F.concat(seed, F.lit("|more")), 256)
    letter = F.when(of == "name", F.regexp_extract(part, rf"[{_L}]", 0)).when(of == "email", "a").otherwise("0")

    def added(j: Column) -> Column:
        vowel = (of == "name") & ((F.length(name) + j) % 2 == 0)
        return _char(F.lower(letter), F.substring(spare, F.pmod(j - 1, F.lit(64)) + 1, F.lit(1)), vowel)

    more = F.when(extra > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(extra, F.lit(1))), added), "")).otherwise("")
    written = F.concat(F.when(of == "email", more).otherwise(""), written, F.when(of == "email", "").otherwise(more))
    # an upper-case hexadecimal secret keeps its case all through
    capitals = (of == "secret") & part.rlike("^[0-9A-F]+$")
    end = F.when(part.rlike(r"\p{IsCyrillic}"), F.when(female == "f", "а").otherwise("н")).when(
        part.rlike(r"\p{IsGreek}"), F.when(female == "f", "α").otherwise("ς")).otherwise(F.when(female == "f", "a").otherwise("o"))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda j: (
        F.conv(F.substring(digest, 4 * j + 1, F.lit(4)), 16, 10).cast("int") % 254 + 1).cast("string")), ".")
    groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda j: F.when(j == 0, F.concat(
        F.lit("2"), F.substring(digest, 2, 3))).otherwise(F.substring(digest, 4 * j + 1, F.lit(4)))), ":")
    return F.when((of == "ip") & part.contains(":"), groups).when(of == "ip", octets).otherwise(_let(
        written, lambda w: F.when(capitals, F.upper(w)).when(of == "name", F.concat(w, end)).otherwise(w)))


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (of, part, norm, gender) of all documents; one row per writing."""
    found = (docs.where(may_hold(F.col(f"`{text}`")))
             .select(F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(ANY), F.lit(0))).alias("e")).distinct())
    found = found.withColumn("of", kind(F.col("e"))).withColumn("gender", gender(F.col("e"), F.col("of")))
    return (found.select("of", "gender", F.explode(parts(F.col("e"), F.col("of"))).alias("part"))
            .withColumn("norm", norm(F.col("part"), F.col("of"))).distinct())


def turns(found: DataFrame, key: str = KEY) -> DataFrame:
    """(of, norm, turn) of the entities whose first surrogate cannot be used; every other has turn 0.

    Of several entities with one surrogate the least keeps it. An entity is hashed again while its
    surrogate is another one's or is an entity of the corpus itself. Surrogates grow with the turns, so
    there are ever more free ones and the rounds end however many entities a short form has; addresses
    cannot grow, and if they fill their space this fails.
    """
    hashed = surrogate(F.col("part"), F.col("of"), F.col("gender"), F.col("turn"), key)
    known = norm(F.col("written"), F.col("of"))
    # a row per writing and gender, as each may have a surrogate of its own; the turn is the entity's
    given = saved(found.withColumn("turn", F.lit(0)).withColumn("written", hashed).withColumn("s", known), "op3-given")
    names = given.select("of", F.col("norm").alias("s"))
    for _ in range(MOST_TURNS):
        shared = given.groupBy("of", "s").agg(F.min("norm").alias("least"), F.max("norm").alias("most")).where("least != most")
        twice = given.join(shared, ["of", "s"]).where("norm != least").select("of", "norm")
        taken = given.join(names, ["of", "s"], "left_semi").select("of", "norm")
        bad = saved(twice.union(taken).distinct().withColumn("bad", F.lit(1)), "op3-bad")
        if bad.isEmpty():
            return given.where("turn > 0").select("of", "norm", "turn").distinct()
        given = saved(given.join(bad, ["of", "norm"], "left").withColumn("turn", F.col("turn") + F.coalesce("bad", F.lit(0)))
                      .withColumn("written", F.when(F.col("bad").isNull(), F.col("written")).otherwise(hashed)).drop("bad")
                      .withColumn("s", known), "op3-given")
    left = ", ".join(r["of"] for r in bad.select("of").distinct().orderBy("of").collect())
    raise RuntimeError(f"No free surrogates found in {MOST_TURNS} turns: {left}")


def replace_entities(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """docs with surrogates in place of the entities in ``text``, and n_entities (a column of that name is replaced)."""
    again = turns(entities(docs, text), key)
    none = again.isEmpty()  # then no document has to carry turns
    body = F.col(f"`{text}`")
    empty = F.array().cast("array<string>")
    rows = docs.drop("n_entities").withColumn("__found", F.when(may_hold(body), F.regexp_extract_all(body, F.lit(ANY), F.lit(0))).otherwise(empty))
    if none:
        rows = rows.withColumn("__turns", F.lit(None).cast("map<string,int>"))
    else:  # texts that hold an entity of a later turn carry those turns along: few
        rows = rows.withColumn("__name", F.when(F.size("__found") > 0, F.sha2(body, 256)))
        names = (rows.where(F.size("__found") > 0).select("__name", F.explode(F.array_distinct("__found")).alias("e"))
                 .withColumn("of", kind(F.col("e"))).select("__name", "of", F.explode(parts(F.col("e"), F.col("of"))).alias("p"))
                 .select("__name", "of", norm(F.col("p"), F.col("of")).alias("norm")).distinct())
        per_text = (names.join(again, ["of", "norm"]).groupBy("__name")
                    .agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "of", "norm"), "turn"))).alias("__turns")))
        rows = rows.where("__name is null").withColumn("__turns", F.lit(None).cast("map<string,int>")).unionByName(
            rows.where("__name is not null").join(per_text, "__name", "left"), allowMissingColumns=True).drop("__name")

    def written(e: Column, turns_: Column, known: Column) -> Column:
        of, female = known["of"], known["gender"]

        def one(p: Column) -> Column:
            turn = F.coalesce(turns_[F.concat_ws("|", of, norm(p, of))], F.lit(0))
            return _let(turn, lambda t: surrogate(p, of, female, t, key))

        title = F.when(of == "name", F.regexp_extract(e, TITLE, 0)).otherwise("")
        return F.concat(title, F.array_join(F.transform(parts(e, of), one), " "))

    def replaced(e: Column) -> Column:
        return _let(kind(e), lambda of: _let(F.struct(of.alias("of"), gender(e, of).alias("gender")),
                                             lambda known: written(e, F.col("__turns"), known)))

    stand_ins = F.transform("__found", replaced)
    pieces = F.split(body, ANY, -1)
    whole = F.array_join(F.flatten(F.zip_with(pieces, stand_ins, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    done = {text: F.when(F.size("__found") > 0, whole).otherwise(body), "n_entities": F.size("__found").cast("long")}
    order = [c for c in docs.columns if c != "n_entities"] + ["n_entities"]
    return rows.select(*[done.get(c, F.col(f"`{c}`")).alias(c) for c in order])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"))
