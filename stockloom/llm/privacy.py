"""Personal data replaced by keyed surrogates of the same type and format (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, packed, written

#: Common given names by gender and script, titles by gender.
GIVEN = {
    ("f", "latin"): "Mary Patricia Jane Anna Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Margaret Sandra Ashley Emily Michelle Monika Brigitte Ursula Sabine Isabelle Nathalie Sylvie Carmen Dolores Guadalupe Francisca",
    ("m", "latin"): "John James Robert Peter Paul Michael William David Richard Joseph Thomas Charles Christopher Matthew Anthony Donald Steven Kenneth Wolfgang Juergen Dieter Klaus Philippe Laurent Pascal Francisco Alejandro Fernando Guillermo",
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана",
    ("m", "cyrillic"): "Иван Сергей Дмитрий Алексей Николай Михаил Андрей Владимир",
    ("f", "greek"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία",
    ("m", "greek"): "Γεώργιος Ιωάννης Κωνσταντίνος Δημήτριος Νικόλαος",
}
TITLES = {"f": "Mrs Ms Miss Frau Madame Mme Señora Sra Signora Г-жа Κυρία", "m": "Mr Herr Monsieur Señor Sr Signor Г-н Κύριος"}
#: Syllables of made-up surnames, sixteen per script.
SYLLABLES = {
    "latin": "ba de fi go ku la me ni po ra se ti vo wa ye zu",
    "cyrillic": "ба де фи го ку ла ме ни по ра се ти во жа ке зу",
    "greek": "βα δε φι γο κυ λα με νι πο ρα σε τι βο ξα κε ζυ",
}
ROUNDS = 64

#: Small words inside surnames; country calling codes of one and two digits, all others have three.
PARTICLES = "de da del della di dos du van von der den la le al bin"
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"

_all_given = "|".join(n for names in GIVEN.values() for n in names.split())
_given_capitals = _all_given.upper()
_titles = "|".join(t for names in TITLES.values() for t in names.split())
_NAME = "(?:\\p{Lu}['\u2019])?\\p{Lu}\\p{Ll}+(?:-?\\p{Lu}\\p{Ll}+)*"
_CAPITALS = "(?:\\p{Lu}['\u2019])?\\p{Lu}{2,}(?:-\\p{Lu}{2,})*"
_SURNAME = f"(?:(?:{PARTICLES.replace(' ', '|')}) ){{0,2}}{_NAME}"
_BYTE = "(?:25[0-5]|2[0-4]\\d|1\\d\\d|[1-9]?\\d)"
#: Types in the order in which they are tried at each place; a lookbehind keeps what marks a value outside it.
PATTERNS = {
    "email": "(?<![\\p{L}\\p{N}._%+-])[\\p{L}\\p{N}._%+-]{1,64}+@[\\p{L}\\p{N}-]{1,63}(?:\\.[\\p{L}\\p{N}-]{1,63}){1,8}",
    "key": "\\bAKIA[0-9A-Z]{16}\\b|\\bgh[pousr]_[A-Za-z0-9]{36,}\\b|\\bsk-[A-Za-z0-9]{20,}\\b",
    "secret": "(?<=(?i:token|api[_-]?key|secret|password|passwd|pwd)[\"']?\\s{0,2}[=:]\\s{0,2}[\"']?)[^\\s\"',;]{6,}",
    "iban": "\\b[A-Z]{2}\\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\\b",
    "ip": f"(?<![\\w.]){_BYTE}(?:\\.{_BYTE}){{3}}(?![\\w]|\\.\\d)",
    "card": "(?<![\\w-])\\d{4}(?<gap>[ -]?)\\d{4}\\k<gap>\\d{4}\\k<gap>\\d{1,7}(?![\\w-])",
    "ssn": "(?<![\\w-])\\d{3}-\\d{2}-\\d{4}(?![\\w-])",
    "phone": "(?<![\\w+])\\+\\d{1,3}[ .-]?(?:\\(\\d{1,4}\\)|\\d{1,4})(?:[ .-]?\\d{2,4}){2,4}(?!\\w)|(?<!\\w)\\(\\d{3}\\) ?\\d{3}-\\d{4}(?!\\w)|(?<![\\w.-])\\d{3}(?<dot>[.-])\\d{3}\\k<dot>\\d{4}(?![\\w-])",
    "person": f"(?<![\\p{{L}}\\p{{N}}])(?:(?:{_titles})\\.? (?:(?:(?:{_all_given}) ){{1,2}}{_SURNAME}|{_SURNAME}(?: {_SURNAME})?)"
              f"|(?:{_all_given})(?: (?:{_all_given}))? {_SURNAME}|(?:{_given_capitals})(?: (?:{_given_capitals}))? {_CAPITALS}(?!\\p{{L}}))",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What any text with a match has; far cheaper to look for.
HINT = f"[0-9@]|(?i:token|key|secret|passw|pwd)|(?<!\\p{{L}})(?:(?:{_titles})\\.?|{_all_given}|{_given_capitals}) "


def _checksum(digits: Column, doubled: int) -> Column:
    """The digit sum of card numbers, modulo ten; ``doubled`` is the parity, from the right, of the digits that count twice less nine."""
    total = F.aggregate(F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 != doubled, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(
        c.cast("int"))), F.lit(0), lambda a, x: a + x)
    return F.pmod(total, F.lit(10))


def _mod97(text: Column) -> Column:
    """The remainder by 97 of digits and small letters, a letter standing for its number from ten on."""
    step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise((acc * 100 + F.ascii(c) - 87) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _type(mention: Column) -> Column:
    """The type of a matched text, by its own shape; the marker before a secret is gone, so that comes last."""
    out = F.lit("secret")
    for name in reversed([n for n in PATTERNS if n not in ("secret", "person")]):
        out = F.when(mention.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(out)
    return (F.when(mention.rlike(f"^(?:{PATTERNS['person']})$"), F.lit("person"))
            .when((out == "card") & (_checksum(F.regexp_replace(mention, "[^0-9]", ""), 0) != 0), F.lit("none")).otherwise(out))


def _script(word: Column) -> Column:
    return F.when(word.rlike("\\p{IsCyrillic}"), "cyrillic").when(word.rlike("\\p{IsGreek}"), "greek").otherwise("latin")


def _shuffled_names(key: str) -> dict[str, str]:
    """Each known given name to the next of its gender and script in an order the key decides: never itself, never twice."""
    import hashlib

    out = {}
    for names in GIVEN.values():
        order = sorted(names.split(), key=lambda n: hashlib.sha256(f"{key}:{n}".encode()).hexdigest())
        out |= {n.lower(): m for n, m in zip(order, order[1:] + order[:1])}
    return out


def _literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in d.items() for x in kv))


def searched(docs: DataFrame) -> DataFrame:
    """(_doc, text, _m): the columns besides the text as one struct, and every match in the text; the patterns run here alone."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    found = F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    return docs.select(F.struct(F.lit(0).alias("_0"), *others).alias("_doc"), "text", F.coalesce(found, F.array().cast("array<string>")).alias("_m"))


def mentions(found: DataFrame) -> DataFrame:
    """(_key, pos, mention) of every match of ``searched`` texts; a text that many rows share is listed once."""
    hits = found.where(F.size("_m") > 0).select(F.sha2("text", 256).alias("_key"), F.col("_m").alias("m"))
    return hits.groupBy("_key").agg(F.first("m").alias("m")).select("_key", F.posexplode("m").alias("pos", "mention"))


def parts(found: DataFrame) -> DataFrame:
    """The entities of each mention: (_key, pos, part, text, type, canon); two spellings of one value share ``canon``.

    A name is one entity per word, whatever its capitals, so a surname alone and
    a full name agree; its title and small words (de, van) stay.  An address is
    its local part, under its domain, and its domain.
    """
    kind = _type(F.col("mention"))
    pieces = F.when(F.col("kind") == "person", F.split("mention", " ")).when(F.col("kind") == "email", F.split("mention", "@")).otherwise(F.array("mention"))
    words = lambda names: F.array(*(F.lit(n) for n in names.split()))
    low, bare = F.lower("text"), F.regexp_replace("text", "\\.$", "")
    given = words(" ".join(n.lower() for names in GIVEN.values() for n in names.split()))
    rows = (found.withColumn("kind", kind).withColumn("pieces", pieces)
            .withColumn("title", F.regexp_extract("mention", f"^({_titles})\\.? ", 1))
            .select("*", F.posexplode("pieces").alias("part", "text")))
    of_name = (F.when(((F.col("part") == 0) & (bare == F.col("title"))) | F.col("text").isin(PARTICLES.split()), F.lit("title"))
               .when(F.col("part") == F.size("pieces") - 1, F.lit("surname")).when(F.array_contains(given, low), F.lit("given"))
               .when(F.array_contains(words(TITLES["f"]), F.col("title")), F.lit("given_f")).otherwise(F.lit("given_m")))
    of_type = F.when(F.col("kind") == "person", of_name).when((F.col("kind") == "email") & (F.col("part") == 1), F.lit("domain")).otherwise(F.col("kind"))
    canon = (F.when(F.col("kind") == "email", F.when(F.col("part") == 0, F.lower("mention")).otherwise(low))
             .when(F.col("kind") == "person", low)
             .when(F.col("kind").isin("card", "ssn", "iban"), F.lower(F.regexp_replace("text", "[^0-9A-Za-z]", "")))
             .when(F.col("kind") == "phone", F.regexp_replace("text", "[^0-9+]", "")).otherwise(F.col("text")))
    return rows.select("_key", "pos", "part", "kind", "text", of_type.alias("type"), canon.alias("canon"))


def _stream(key: str) -> Column:
    """Hexadecimal digits that the key, the entity and the attempt decide."""
    base = F.concat_ws("|", F.lit(key), "type", "canon", "attempt")
    return F.concat(*(F.sha2(F.concat_ws("|", base, F.lit(str(i))), 512) for i in range(2)))


def _mapped(chars: Column, stream: Column, letters: int = 26) -> Column:
    """Each letter or digit replaced within its class (digit, small, capital), everything else kept; the stream is used over again."""
    pick = lambda i, n: F.pmod(F.conv(F.substr(stream, (i * 3) % 250 + 1, F.lit(4)), 16, 10).cast("int"), F.lit(n))
    return F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9]"), pick(i, 10).cast("string"))
                                    .when(c.rlike("[a-z]"), F.char(pick(i, letters) + 97)).when(c.rlike("[A-Z]"), F.char(pick(i, 26) + 65)).otherwise(c)), "")


def _draft(key: str) -> Column:
    """The surrogate of an entity in canonical form for its present attempt."""
    s, canon = F.col("_s"), F.col("canon")
    chars = F.split(canon, "")
    octet = lambda i: (F.pmod(F.conv(F.substr(s, F.lit(1 + 4 * i), F.lit(4)), 16, 10).cast("int"), F.lit(254)) + 1).cast("string")
    keep = lambda n, rest: F.concat(F.substring(canon, 1, n), rest)
    tail = lambda n: F.substr(canon, F.lit(n + 1), F.length(canon))
    body = lambda n: _mapped(F.split(tail(n), ""), s)
    number = lambda at, n: F.pmod(F.conv(F.substr(s, F.lit(at), F.lit(7)), 16, 10).cast("int"), F.lit(n))
    # account numbers keep their country and get check digits that fit
    account = _mapped(F.split(tail(4), ""), s)
    check = 98 - _mod97(F.concat(account, F.substring(canon, 1, 2), F.lit("00")))
    iban = F.concat(F.substring(canon, 1, 2), F.lpad(check.cast("string"), 2, "0"), account)
    # telephone numbers keep their country; area and exchange begin with 2 to 9
    code = F.regexp_extract("canon", f"^\\+(?:{CALLING.replace(' ', '|')}|\\d{{3}})", 0)
    dial = F.transform(F.split(F.substr(canon, F.length(code) + 1, F.length(canon)), ""), lambda c, i: F.when(
        i.isin(0, 3), F.pmod(F.conv(F.substr(s, (i * 3) % 250 + 1, F.lit(4)), 16, 10).cast("int"), F.lit(8)) + 2).otherwise(
        F.pmod(F.conv(F.substr(s, (i * 3) % 250 + 1, F.lit(4)), 16, 10).cast("int"), F.lit(10))).cast("string"))
    # social security numbers that may exist: area 001 to 899 but 666, group and serial not zero
    area = number(1, 898) + 1
    ssn = F.concat(F.lpad((area + (area >= 666).cast("int")).cast("string"), 3, "0"), F.lpad((number(9, 99) + 1).cast("string"), 2, "0"),
                   F.lpad((number(17, 9999) + 1).cast("string"), 4, "0"))
    card = keep(1, body(1))
    front = F.substr(card, F.lit(1), F.length(card) - 1)
    card = F.concat(front, F.pmod(-_checksum(front, 1), F.lit(10)).cast("string"))
    long = F.repeat(F.substr(s, F.lit(60), F.lit(1)), (F.col("attempt") / 8).cast("int"))
    syllables = F.lit(None).cast("array<string>")
    for name, text in SYLLABLES.items():
        syllables = F.when(_script(canon) == name, F.array(*map(F.lit, text.split()))).otherwise(syllables)
    word = F.array_join(F.transform(F.sequence(F.lit(1), (3 + F.col("attempt") / 4).cast("int")), lambda i: F.element_at(
        syllables, F.conv(F.substr(s, i, F.lit(1)), 16, 10).cast("int") + 1)), "")
    ending = lambda by_script: F.element_at(_literal_map(dict(zip(SYLLABLES, by_script.split()))), _script(canon))
    local = F.split_part(canon, F.lit("@"), F.lit(1))
    domain = F.regexp_extract("canon", "^(.*)(\\.[^.]*)$", 1)
    given = F.element_at(_literal_map(_shuffled_names(key)), canon)
    return (F.when(F.col("type") == "ip", F.concat_ws(".", *(octet(i) for i in range(4))))
            .when(F.col("type") == "card", card)
            .when(F.col("type") == "phone", F.concat(code, F.array_join(dial, "")))
            .when(F.col("type") == "iban", iban)
            .when(F.col("type") == "ssn", ssn)
            .when(F.col("type").isin("none", "title"), canon)
            .when(F.col("type") == "given", F.lower(given))
            .when(F.col("type") == "given_f", F.concat(word, ending("a а α")))
            .when(F.col("type") == "given_m", F.concat(word, ending("n н ς")))
            .when(F.col("type") == "surname", word)
            .when(F.col("type") == "email", F.concat(_mapped(F.split(local, ""), s), long))
            .when(F.col("type") == "domain", F.concat(_mapped(F.split(domain, ""), s), long, F.regexp_extract("canon", "\\.[^.]*$", 0)))
            .when((F.col("type") == "key") & canon.startswith("AKIA"), keep(4, body(4)))
            .when(F.col("type") == "key", F.concat(F.regexp_extract("canon", "^[a-z]+[_-]", 0), _mapped(F.split(F.regexp_replace("canon", "^[a-z]+[_-]", ""), ""), s)))
            .when(canon.rlike("^[0-9a-f]+$"), _mapped(chars, s, 6)).otherwise(F.concat(_mapped(chars, s), long)))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(type, canon, surrogate), different for different entities of a type and never a value that itself occurs.

    A surrogate that two entities drew, or that is a real value, is drawn again
    by all but the first of them, until none is left; each round is written.
    """
    value = F.when(F.col("type") == "email", F.concat("surrogate", F.lit("@"), F.split_part("canon", F.lit("@"), F.lit(2)))).otherwise(F.col("surrogate"))
    now = written(entities.withColumn("attempt", F.lit(0)))
    for _ in range(ROUNDS):
        drawn = now.withColumn("_s", _stream(key)).withColumn("surrogate", _draft(key)).drop("_s").withColumn("_value", value)
        drawn = written(drawn)
        # known given names are a fixed exchange among themselves
        free = drawn.where("type not in ('given', 'title', 'none')")
        twice = free.groupBy("type", "_value").agg(F.count("*").alias("n"), F.min("canon").alias("keeps")).where("n > 1").select("type", "_value", "keeps")
        real = free.select("type", "_value").distinct().join(now.select("type", F.col("canon").alias("_value")), ["type", "_value"], "left_semi").withColumn("keeps", F.lit(None).cast("string"))
        bad = written(twice.union(real).groupBy("type", "_value").agg(F.min("keeps").alias("keeps"), F.max(F.col("keeps").isNull()).alias("real")))
        if bad.isEmpty():
            return drawn.select("type", "canon", "surrogate")
        new = written(drawn.join(bad, ["type", "_value"], "left").select(
            "type", "canon", (F.col("attempt") + F.coalesce((F.col("real") | (F.col("canon") != F.col("keeps"))).cast("int"), F.lit(0))).alias("attempt")))
        for old in (now, drawn, bad):
            discard(old)
        now = new
    raise RuntimeError("surrogates still collide; their space is too small for this many entities")


def _rendered() -> Column:
    """The surrogate in the mention's own spelling: its separators, its case, its capital."""
    spelled = F.transform(F.split("text", ""), lambda c, i: c)
    step = lambda acc, c: F.when(c.rlike("[0-9A-Za-z]"), F.struct(
        F.concat(acc["out"], F.substr(F.ltrim("surrogate", F.lit("+")), acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"))).otherwise(
        F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at")))
    separated = F.aggregate(spelled, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step, lambda acc: acc["out"])
    cased = F.when(F.col("text") == F.upper("text"), F.upper("surrogate")).otherwise(F.col("surrogate"))
    return (F.when(F.col("type").isin("title", "none"), F.col("text")).when(F.col("type").isin("card", "ssn", "phone"), separated).when(F.col("type") == "iban", F.upper(separated))
            .when(F.col("type").isin("given", "given_f", "given_m", "surname"), F.when((F.col("text") == F.upper("text")) & (F.length("text") > 1), F.upper("surrogate")).otherwise(F.initcap("surrogate"))).when(F.col("type").isin("email", "domain"), cased)
            .otherwise(F.col("surrogate")))


def replaced(docs: DataFrame, key: str = "surrogates-1") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_entities``, the mentions replaced.

    A card number must pass its check digit, and account numbers get fitting ones; telephone numbers keep their country.
    A name is a title or a listed given name with what follows it, or a listed one all in capitals.  The same value becomes the same surrogate in every document, however it is
    spelled, and different values different ones.  Texts without a match, null
    and empty ones come back as they are, with 0; repeated rows are replaced
    alike; an empty table stays empty.  Other columns are untouched, whatever
    their names; one called n_entities gives way to the new one.
    """
    found = written(searched(docs))
    listed = written(parts(mentions(found)))
    made = surrogates(listed.select("type", "canon").distinct(), key)
    done = listed.join(made, ["type", "canon"]).withColumn("out", _rendered())
    whole = (done.groupBy("_key", "pos").agg(F.array_sort(F.collect_list(F.struct("part", "out"))).alias("o"), F.first("kind").alias("kind"),
                                             F.max(F.when(F.col("type") == "surname", F.struct("text", "out"))).alias("surname"))
             .withColumn("o", F.transform("o", lambda x: x["out"]))
             .withColumn("out", F.when(F.col("kind") == "email", F.array_join("o", "@")).otherwise(F.array_join("o", " "))))
    by_text = written(whole.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("pos", "out"))).alias("o"), F.array_sort(F.collect_set("surname")).alias("_surnames"),
                                                F.count(F.when(F.col("kind") != "none", 1)).alias("_n"))
                      .select(F.col("_key").alias("_text_key"), F.transform("o", lambda x: x["out"]).alias("_out"), "_surnames", "_n"))
    gaps = F.split("text", ANY, -1)
    text = F.array_join(F.zip_with(gaps, F.col("_out"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    # a surname that stands alone elsewhere in the text means the same person, in capitals too
    alone = lambda t, old, new: F.when(t.contains(old), F.regexp_replace(t, F.concat(F.lit("(?<![\\p{L}\\p{N}])"), old, F.lit("(?![\\p{L}\\p{N}])")), new)).otherwise(t)
    spellings = F.array_distinct(F.flatten(F.transform("_surnames", lambda x: F.array(
        x, F.struct(F.upper(x["text"]).alias("text"), F.upper(x["out"]).alias("out")), F.struct(F.initcap(x["text"]).alias("text"), F.initcap(x["out"]).alias("out"))))))
    text = F.aggregate(spellings, text, lambda t, x: alone(t, x["text"], x["out"]))
    columns = [c for c in docs.columns if c != "n_entities"]

    def rows(df: DataFrame, text: Column, n: Column) -> DataFrame:
        return df.select(*(text.alias("text") if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in columns), n.alias("n_entities"))

    with_data = found.where(F.size("_m") > 0).withColumn("_text_key", F.sha2("text", 256)).join(by_text, "_text_key")
    return rows(with_data, text, F.col("_n")).union(rows(found.where(F.size("_m") == 0), F.col("text"), F.lit(0).cast("long")))


def surrogate_texts(docs: DataFrame, key: str = "surrogates-1") -> DataFrame:
    """``docs`` with replaced texts and all other columns as they were; a column ``n_chars`` follows a changed text."""
    out = replaced(packed(docs, "text", without=("text",)), key)
    chars = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("_doc.n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col("text"), "n_chars": chars}
    return out.select(*((new[c] if new.get(c) is not None else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns))
