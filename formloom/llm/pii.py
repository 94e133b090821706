"""Surrogates for personal data, from DataFrame functions alone.

Found: e-mail addresses, phone numbers, IPv4 addresses, payment cards (13 to 19 digits of an issuer's range whose check digit is right),
social security numbers, access keys, values assigned to words such as `password` or `token` (of any length, dots inside included), and
names: after a form of address or a title, after "my name is", and a common given name followed by a capitalised word.
An entity has parts: an address its local part and its domain, a name its given and its family name, all others one. Each part
gets a surrogate of its kind, drawn from a keyed hash of its canonical form:

* Format: digits stay digits, letters stay letters of their case and script, hexadecimal stays so, separators stay in place.
  Cards keep the issuer's first digits and a right check digit; phone numbers keep their country code, and North American ones have
  area and exchange codes that exist; addresses keep the domain's ending; social security numbers avoid the areas, groups and serials that are never given out; IPv4
  addresses stay private, loopback, multicast or reserved where they are, and are public otherwise.
* Names keep the gender that the form of address or the given name shows, and their script.
* Coreference: parts with one canonical form (digits without separators, numbers with and without the country code 1, lower-cased letters)
  share a surrogate, so "Mr. John Smith" and "Mr. Smith" keep one family name, and addresses of one domain keep one domain.
* Distinctness: all parts of the corpus are listed, each once. A surrogate that several of them drew, or that is
  itself one of them, is drawn again with a higher attempt until none collides; of several the first keeps its draw. From attempt LONGER on, draws
  are one character longer, from twice that two, and so on: where a format has no free values left, a longer form is used. Documents that
  hold a part that was drawn again get its final surrogate by a join; all others need none.

A family name that stands alone, without form of address, is not found, nor are names outside the lists.
A null text stays null and an empty one empty. Text without entities is returned as it is, other columns always are. Rows with
null or repeated ids are treated alike. An input column named n_entities is replaced. The key is the caller's secret; there is none by default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import Scratch

WORD = r"[\p{L}\p{N}._%+-]"
#: Forms of address, titles, and common given names by gender.
FEMALE, MALE, TITLE = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|Κυρία", "Mr|Herr|Monsieur|Señor|Sr|Господин|Κύριος", "Dr|Prof|Professor|Доктор|Профессор"
WOMEN = "Anna|Barbara|Catherine|Charlotte|Christina|Deborah|Elizabeth|Emily|Emma|Hannah|Helen|Jennifer|Jessica|Julia|Karen|Laura|Linda|Margaret|Maria|Mary|Nancy|Olivia|Patricia|Rebecca|Sarah|Sophia|Susan|Susanne"
MEN = "Alexander|Andrew|Anthony|Benjamin|Charles|Christopher|Daniel|David|Edward|George|Hans|James|John|Joseph|Klaus|Matthew|Michael|Nicholas|Paul|Peter|Pierre|Richard|Robert|Stephen|Steven|Thomas|Walter|William"
PERSON = r"\p{Lu}\p{Ll}{1,40}"
NAME = rf"(?:(?:{FEMALE}|{MALE}|{TITLE})\.? {PERSON}(?: {PERSON})?|(?i:my name is) {PERSON}(?: {PERSON})?|(?:{WOMEN}|{MEN}) {PERSON})"
BEFORE_NAME = rf"^(?:(?:{FEMALE}|{MALE}|{TITLE})\.? |(?i:my name is) )"
ASSIGNED = r"(?i:token|password|passwd|secret|api_?key)[ ]{0,2}[=:][ ]{0,2}[\"']?"
SECRET = r"[A-Za-z0-9_/+.~=-]{7,}[A-Za-z0-9_/+~=-]"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: First digits of cards, and country codes of one and two digits (all others have three).
ISSUERS = r"^(?:4|5[0-8]|6|35(?:2[89]|[3-8])|3(?:0[0-5]|[4678]|9)|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720))"
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
ENTITY = "|".join(
    [
        rf"(?<!{WORD}){WORD}{{1,64}}+@[\p{{L}}\p{{N}}-]{{1,63}}(?:\.[\p{{L}}\p{{N}}-]{{1,63}}){{1,8}}",
        r"(?<![\p{L}\p{N}])AKIA[A-Z0-9]{16}(?![A-Z0-9])",
        rf"(?<![\p{{L}}\p{{N}}]){ASSIGNED}{SECRET}",
        rf"(?<![\p{{L}}\p{{N}}]){NAME}(?!\p{{L}})",
        rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
        r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)",
        r"(?<![\p{L}\p{N}(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
        r"(?<![\d.-])\d{3}-\d{3}-\d{4}(?![\d-])",
        r"(?<![\d.-])\d{3}-\d{2}-\d{4}(?![\d-])",
        r"(?<![\p{L}\p{N}.-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})(?![\p{L}\p{N}-])",
    ]
)
#: Draws get longer by one character at each so many attempts.
LONGER = 8
#: Parts that were drawn again are joined under so many salts.
SALTS = 16
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
GIVEN = {
    ("latin", "f"): "anna clara edith helen irene julia laura maria nora paula rosa vera",
    ("latin", "m"): "albert bruno carl daniel emil felix gustav hugo leon martin oscar paul",
    ("cyrillic", "f"): "анна вера галина елена ирина лидия мария нина ольга софия тамара юлия",
    ("cyrillic", "m"): "антон борис виктор глеб денис егор иван лев марк олег павел роман",
    ("greek", "f"): "άννα ελένη ζωή ειρήνη μαρία νίκη σοφία χαρά",
    ("greek", "m"): "άρης γιάννης κώστας λέων νίκος πέτρος στέλιος φώτης",
    ("latin", "n"): "alex andrea chris dominique jean kim luca robin sam toni",
    ("cyrillic", "n"): "женя саша слава валя",
    ("greek", "n"): "άλεξ χρίς",
}
SYLLABLES = {
    "latin": "bal cor den fal gar hol kin lam mer nor pel ros sal tor vin wes",
    "cyrillic": "бал вор ган дол ков лан мир нов пет рос сав тар",
    "greek": "βαλ γαρ δελ καλ λαμ μαρ νικ παπ ροδ σαλ",
}


def let(value: Column, body) -> Column:
    """`body` of the value, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def check_sum(number: Column) -> Column:
    """Sum of a number's digits, every second one from the right but the last doubled, as cards are checked."""
    doubled = lambda c, i: F.when(i % 2 == 1, c * 2 - F.when(c > 4, 9).otherwise(0)).otherwise(c)
    each = F.transform(F.split(F.reverse(number), ""), lambda c: c.cast("int"))
    return F.aggregate(F.transform(each, doubled), F.lit(0), lambda a, b: a + b)


def _script(e: Column) -> Column:
    return F.when(e.rlike(r"\p{IsCyrillic}"), "cyrillic").when(e.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def kind_of(e: Column) -> Column:
    """An entity's kind; null for digits that are no card."""
    return (
        F.when(F.contains(e, F.lit("@")), "email")
        .when(e.rlike(r"^AKIA[A-Z0-9]{16}$"), "key")
        .when(e.rlike(f"^{ASSIGNED}"), "secret")
        .when(e.rlike(r"^\p{L}"), "name")
        .when(e.rlike(r"^\d+\.\d+\.\d+\.\d+$"), "ip")
        .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(e.rlike(r"^(?:\+|\(|\d{3}-\d{3}-)"), "phone")
        .when(digits(e).rlike(ISSUERS) & (check_sum(digits(e)) % 10 == 0), "card")
    )


def _named_parts(e: Column) -> Column:
    """Family and given name of a name; of one word after a form of address, that is the family name."""
    bare = F.regexp_replace(e, BEFORE_NAME, "")
    given, family = F.lower(F.substring_index(bare, " ", 1)), F.lower(F.substring_index(bare, " ", -1))
    gender = F.when(e.rlike(rf"^(?:{FEMALE})\.? "), "f").when(e.rlike(rf"^(?:{MALE})\.? "), "m").when(bare.rlike(rf"^(?:{WOMEN}) "), "f").when(bare.rlike(rf"^(?:{MEN}) "), "m").otherwise("n")
    part = lambda kind, value: F.struct(kind.alias("kind"), value.alias("value"))
    last = part(F.concat(F.lit("family:"), _script(e)), family)
    first = part(F.concat_ws(":", F.lit("given"), gender, _script(e)), given)
    return F.when(F.contains(bare, F.lit(" ")), F.array(last, first)).otherwise(F.array(last))


def parts_of(kind: Column, e: Column) -> Column:
    """array<struct<kind, value>>: kinds and canonical forms of an entity's parts."""
    one = lambda value: F.array(F.struct(kind.alias("kind"), value.alias("value")))
    domain = F.lower(F.substring_index(e, "@", -1))
    mail = F.array(F.struct(F.lit("local").alias("kind"), F.lower(e).alias("value")), F.struct(F.lit("domain").alias("kind"), domain.alias("value")))
    north = F.when(F.startswith(e, F.lit("+")), digits(e)).otherwise(F.concat(F.lit("1"), digits(e)))
    return (
        F.when(kind == "email", mail).when(kind == "name", _named_parts(e)).when(kind == "phone", one(north)).when(kind.isin("card", "ssn"), one(digits(e)))
        .when(kind == "secret", one(F.regexp_replace(e, f"^{ASSIGNED}", ""))).when(kind.isNotNull(), one(e))
    )


def _stream(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """Two hexadecimal digits for each character of the value, from a keyed hash."""
    block = lambda b: F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), b.cast("string"), value), 256)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(value) / 32).cast("int")), block), "")


def _byte(stream: Column, i) -> Column:
    return F.conv(F.substr(stream, F.lit(2) * i + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substr(F.lit(letters), n % len(letters) + 1, F.lit(1))


def _disguise(kind: Column, value: Column, stream: Column) -> Column:
    """Each digit and letter replaced by another of its sort."""
    hexadecimal = (kind == "secret") & value.rlike("^[0-9a-f]+$") & value.rlike("[a-f]")

    def one(c, i):
        n = _byte(stream, i)
        letter = lambda name, test: F.when(F.lower(c).rlike(test), _pick(ALPHABETS[name], n))
        low = F.coalesce(letter("cyrillic", r"\p{IsCyrillic}"), letter("greek", r"\p{IsGreek}"), letter("latin", r"\p{L}"))
        return let(low, lambda own: (
            F.when(hexadecimal, _pick("0123456789abcdef", n))
            .when(c.rlike(r"\p{N}"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{Lu}"), F.upper(own))
            .otherwise(F.coalesce(own, c))
        ))

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _words(kind: Column, x: Column, attempt: Column) -> Column:
    """Given and family names of a kind; each attempt from the third on draws a longer one, so names never run out."""
    at = lambda words, i: F.element_at(F.array(*map(F.lit, words.split())), _byte(x, i) % len(words.split()) + 1)
    drawn = lambda words, least: F.array_join(F.transform(F.sequence(F.lit(1), F.least(attempt.cast("int") / 2, F.lit(28)).cast("int") + least), lambda i: at(words, i)), "")
    names = F.when(F.lit(False), kind)
    for script, syllables in SYLLABLES.items():
        names = names.when(kind == f"family:{script}", drawn(syllables, 2))
    for (script, gender), given in GIVEN.items():
        names = names.when(kind == f"given:{gender}:{script}", drawn(given, 1))
    return names


def _number(x: Column, at: int, low: int, high: int, width: int) -> Column:
    """A number from low to high, with leading zeros."""
    n = _byte(x, F.lit(at)) * 65536 + _byte(x, F.lit(at + 1)) * 256 + _byte(x, F.lit(at + 2))
    return F.lpad((n % (high - low + 1) + low).cast("string"), width, "0")


def _ip(value: Column, x: Column, attempt: Column) -> Column:
    """Of the range that the value is of; where that has no free addresses left, of the private range 10, and at last a public one."""
    rest = lambda n: F.array_join(F.transform(F.array(*map(F.lit, range(n))), lambda i: (_byte(x, i + 1) % 254 + 1).cast("string")), ".")
    first = F.substring_index(value, ".", 1).cast("int")
    head = F.when(first >= 240, 240 + _byte(x, F.lit(0)) % 15).when(first >= 224, 224 + _byte(x, F.lit(0)) % 16).when(first.isin(0, 10, 127), first).otherwise(11 + _byte(x, F.lit(0)) % 89)
    private = F.when(value.rlike(r"^192\.168\."), "192.168.").when(value.rlike(r"^169\.254\."), "169.254.").when(value.rlike(r"^172\.(?:1[6-9]|2\d|3[01])\."), F.concat(F.lit("172."), (16 + _byte(x, F.lit(0)) % 16).cast("string"), F.lit(".")))
    head = F.when(attempt < LONGER, head).otherwise(F.when((first == 10) | private.isNotNull(), F.when(attempt < 2 * LONGER, 10)))
    head = F.coalesce(head, 11 + _byte(x, F.lit(0)) % 89)
    return F.coalesce(F.when(attempt < LONGER, F.concat(private, rest(2))), F.concat(head.cast("string"), F.lit("."), rest(3)))


def _phone(value: Column, plain: Column) -> Column:
    """Keeps the country code; area and exchange codes of North American numbers begin with 2 to 9."""
    code = F.length(F.regexp_extract(value, COUNTRY, 0))
    some = lambda at: (F.substring(plain, at, 1).cast("int") % 8 + 2).cast("string")
    north = F.concat(F.lit("1"), some(2), F.substring(plain, 3, 2), some(5), plain.substr(F.lit(6), F.length(plain)))
    return F.when(F.startswith(value, F.lit("1")) & (F.length(value) == 11), north).otherwise(F.concat(F.substr(value, F.lit(1), code), F.substr(plain, code + 1)))


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The canonical form of a part's surrogate. What several places need is worked out, and written into the plan, once."""
    more = F.floor(attempt / LONGER).cast("int")
    local, domain, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1), F.regexp_replace(value, r"\.[^.]+$", "")
    taken = F.when(kind == "local", local).when(kind == "domain", host).otherwise(value)
    longer = F.when(more > 0, F.concat(taken, F.repeat(F.lit("0"), more))).otherwise(taken)
    # The local part's draw depends on its domain.
    seed = F.when(kind == "local", F.concat(longer, F.lit("@"), domain)).otherwise(longer)

    def drawn(p):
        kept = F.when(value.rlike("^[46]"), 1).when(F.startswith(value, F.lit("5")), 2).otherwise(4)
        body = F.concat(F.substr(value, F.lit(1), kept), F.substr(p, kept + 1, F.length(p) - 1 - kept))
        card = let(body, lambda b: F.concat(b, ((F.lit(10) - check_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        return (
            F.when(kind == "local", F.concat(p, F.lit("@"), domain))
            .when(kind == "domain", F.concat(p, F.substr(value, F.length(host) + 1)))
            .when(kind == "card", card)
            .when(kind == "phone", _phone(value, p))
            .when(kind == "key", F.concat(F.lit("AKIA"), p.substr(F.lit(5), F.length(p))))
            .otherwise(p)
        )

    def chosen(x):
        return (
            F.when(kind == "ip", _ip(value, x, attempt))
            .when(kind == "ssn", F.concat(_number(x, 0, 1, 665, 3), _number(x, 3, 1, 99, 2), _number(x, 6, 1, 9999, 4), F.repeat(F.lit("0"), more)))
            .when(F.startswith(kind, F.lit("family")) | F.startswith(kind, F.lit("given")), _words(kind, x, attempt))
            .otherwise(let(longer, lambda v: let(_disguise(kind, v, x), drawn)))
        )

    return let(_stream(key, kind, seed, attempt), chosen)


def laid_out(kind: Column, e: Column, s: Column) -> Column:
    """Canonical surrogates of an entity's parts in the format of the entity."""
    one = F.get(s, F.lit(0))
    number = F.when((kind == "phone") & ~F.startswith(e, F.lit("+")), F.substr(one, F.lit(2))).otherwise(one)
    nothing = lambda c: F.coalesce(c, F.lit(""))
    numbers = F.array_join(F.zip_with(F.split(e, r"\d", -1), F.split(number, ""), lambda gap, d: F.concat(nothing(gap), nothing(d))), "")
    mail = F.concat(F.substring_index(one, "@", 1), F.lit("@"), F.get(s, F.lit(1)))
    same = F.length(mail) == F.length(e)
    cased = F.array_join(F.zip_with(F.split(e, ""), F.split(mail, ""), lambda a, b: F.when(a.rlike(r"\p{Lu}"), F.upper(b)).otherwise(nothing(b))), "")
    return (
        F.when(kind.isin("phone", "card", "ssn"), numbers)
        .when(kind == "secret", F.concat(F.regexp_extract(e, f"^{ASSIGNED}", 0), one))
        .when(kind == "name", F.concat(F.regexp_extract(e, BEFORE_NAME, 0), F.initcap(F.concat_ws(" ", F.get(s, F.lit(1)), one))))
        .when(kind == "email", F.when(same, cased).otherwise(mail))
        .otherwise(one)
    )


def entities(text: Column) -> Column:
    """array<struct<surface, kind, parts>>: the matches of ENTITY in order; kind and parts are null for what is none."""
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    typed = F.transform(found, lambda e: let(kind_of(e), lambda k: F.struct(e.alias("surface"), k.alias("kind"), parts_of(k, e).alias("parts"))))
    return F.coalesce(typed, F.array().cast("array<struct<surface:string,kind:string,parts:array<struct<kind:string,value:string>>>>"))


def _parts(found: Column) -> Column:
    """All parts of a text's entities, each once."""
    return F.array_distinct(F.flatten(F.transform(F.filter(found, lambda e: e["kind"].isNotNull()), lambda e: e["parts"])))


def redrawn(listed: DataFrame, key: str, scratch: Scratch, draw=surrogate) -> DataFrame | None:
    """(kind, value, final) of the parts whose first draw collides; None if there are none. listed: kind, value, drawn."""
    held = listed.select("kind", F.col("drawn").alias("at"), F.lit(1).alias("claims"), F.lit(0).alias("own"), F.col("value").alias("first"))
    held = held.unionByName(listed.select("kind", F.col("value").alias("at"), F.lit(0).alias("claims"), F.lit(1).alias("own"), F.lit(None).cast("string").alias("first")))
    held = held.groupBy("kind", "at").agg(F.sum("claims").alias("claims"), F.max("own").alias("own"), F.min("first").alias("first"))
    bad = held.where("claims > 0 and (claims > 1 or own = 1)").select("kind", F.col("at").alias("drawn"), "own", "first")
    lost = scratch.save(listed.join(bad, ["kind", "drawn"]).where("own = 1 or value <> first").select("kind", "value"), "lost0")
    done, attempt = None, 0
    while lost.limit(1).count():
        attempt += 1
        if attempt > 32 * LONGER:
            raise RuntimeError("over 32 characters more than a format has were not enough for free surrogates")
        tried = lost.withColumn("final", draw(key, F.col("kind"), F.col("value"), F.lit(attempt)))
        tried = scratch.save(tried, f"tried{attempt}")
        taken = listed.select("kind", F.col("drawn").alias("final")).unionByName(listed.select("kind", F.col("value").alias("final")))
        taken = taken if done is None else taken.unionByName(done.select("kind", "final"))
        firsts = tried.groupBy("kind", "final").agg(F.min("value").alias("value")).join(taken, ["kind", "final"], "left_anti")
        good = scratch.save(firsts.select("kind", "value", "final"), f"good{attempt}")
        done = good if done is None else done.unionByName(good)
        lost = scratch.save(lost.join(good, ["kind", "value"], "left_anti"), f"lost{attempt}")
    return done


def key_of(spark: SparkSession) -> str:
    """The session's key. The registered queries read made-up tables, and go by a public one where none is set."""
    return spark.conf.get("spark.formloom.pii.key", "public key, for made-up tables only")


def replace(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", draw=surrogate) -> DataFrame:
    """The rows of `df` with surrogates in their text, and n_entities. key: secret of the surrogates' hash."""
    scratch = Scratch(df.sparkSession, "pii")
    text = F.col(text_col).cast("string")
    found = df.select(F.explode(_parts(entities(text))).alias("p")).select("p.kind", "p.value").distinct()
    listed = scratch.save(found.withColumn("drawn", draw(key, F.col("kind"), F.col("value"), F.lit(0))), "listed")
    finals = redrawn(listed, key, scratch, draw)
    names = [c for c in df.columns if c != "n_entities"]
    rows = df.select(*names, entities(text).alias("_found"))
    final = F.lit(None).cast("map<string,string>")
    if finals is not None:
        row = F.xxhash64(F.col(id_col), text)
        hits = df.select(row.alias("_row"), F.explode(_parts(entities(text))).alias("p")).select("_row", "p.kind", "p.value", F.pmod("_row", F.lit(SALTS)).cast("int").alias("salt"))
        salted = finals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a part may be in a third of all documents
        maps = hits.join(salted, ["kind", "value", "salt"]).groupBy("_row").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "value"), "final"))).alias("_final"))
        rows, final = rows.withColumn("_row", row).join(scratch.save(maps, "maps"), "_row", "left"), F.col("_final")

    def own(p):
        known = F.get(F.filter(F.map_entries(final), lambda m: m["key"] == F.concat_ws("|", p["kind"], p["value"]))["value"], F.lit(0))
        first = draw(key, p["kind"], p["value"], F.lit(0))
        return F.coalesce(known, first) if finals is not None else first

    put = lambda e: F.when(e["kind"].isNull(), e["surface"]).otherwise(let(F.transform(e["parts"], own), lambda s: laid_out(e["kind"], e["surface"], s)))
    between = F.split(F.col(text_col), ENTITY, -1)
    written = F.array_join(F.zip_with(between, F.transform("_found", put), lambda gap, e: F.concat(gap, F.coalesce(e, F.lit("")))), "")
    count = F.size(F.filter("_found", lambda e: e["kind"].isNotNull()))
    replaced = F.when(count == 0, F.col(text_col)).otherwise(written)
    return rows.select(*(replaced.alias(c) if c == text_col else F.col(c) for c in names), count.cast("long").alias("n_entities"))
