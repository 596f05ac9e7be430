"""Personal data replaced by surrogates: keyed, of the same type and format, distinct and consistent.

One expression finds all entities of a text. Each distinct entity of the corpus gets one surrogate, drawn from
a keyed digest of its kind and normal form, so the same person, address or number is the same
surrogate in every document, however it is written. Surrogates keep what a reader sees of the
original: punctuation and lengths, the script of letters, the country code, the check digit of a card, the
gender of a given name. No two entities of a kind share a surrogate and no surrogate is an entity
of the corpus: clashes are found by joins and drawn again, in rounds, until none is left.

Texts without entities are not shuffled. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.llm.common import only, saved

MALE = "Mr|Herr|Señor|Monsieur|Signor|Mister"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mme|Mlle|Signora"
NEUTRAL = "Dr|Prof|Doctor|Professor"
TITLE = rf"(?:{FEMALE}|{MALE}|{NEUTRAL})"
NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
WORD_BEFORE, WORD_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
#: A part of a name.
WORD = r"[\p{L}'’-]+"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+"
PHONE = rf"(?<![\p{{L}}\p{{N}}+])\+(?:1[ .-]?\(?[0-9]{{3}}\)?[ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}|(?:7|[2-9][0-9]{{1,2}})(?:[ .-]?\(?[0-9]{{1,4}}\)?)(?:[ .-]?[0-9]{{2,4}}){{2,4}}){WORD_AFTER}"
CARD = rf"{WORD_BEFORE}(?<![0-9][.-])(?:[0-9]{{13,19}}|[0-9]{{4}}([ -])[0-9]{{4}}\1[0-9]{{4}}\1[0-9]{{1,7}}){WORD_AFTER}"
SSN = rf"{WORD_BEFORE}(?<![0-9][.-])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{WORD_AFTER}(?!-[0-9])"
IP = rf"{WORD_BEFORE}(?<![0-9][.])(?:{OCTET}\.){{3}}{OCTET}{WORD_AFTER}(?!\.[0-9])"
TITLE_GAP = r"(?:\.[ \t\u00A0]*|[ \t\u00A0]+)"
INITIAL = r"\p{Lu}\.[ ]?"
PERSON = rf"{WORD_BEFORE}{TITLE}{TITLE_GAP}(?:{INITIAL}){{0,3}}{NAME}(?:[ ](?:{INITIAL}){{0,3}}{NAME})?{WORD_AFTER}"
#: Most specific first; the group of CARD is the only one.
ENTITY = f"{EMAIL}|{PHONE}|{CARD}|{SSN}|{IP}|{PERSON}"
#: Country codes of one and two digits; all others have three.
COUNTRY = "[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
#: What every entity holds something of.
HINT = f"@|\\+[0-9]|[0-9]{{4}}|[0-9]\\.[0-9]|{TITLE}"

ALPHABETS = (
    ("abcdefghijklmnopqrstuvwxyz", "[a-z]"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[A-Z]"), ("0123456789", "[0-9]"),
    ("àáâäçèéêëìíîïñòóôöùúûü", r"[ß-ſ&&\p{Ll}]"), ("ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ", r"[À-ſ&&\p{Lu}]"),
    ("абвгдежзиклмнопрстуфхцчшэюя", r"[\p{IsCyrillic}&&\p{Ll}]"), ("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", r"[\p{IsCyrillic}&&\p{Lu}]"),
    ("αβγδεζηθικλμνξοπρστυφχψω", r"[\p{IsGreek}&&\p{Ll}]"), ("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", r"[\p{IsGreek}&&\p{Lu}]"),
)
SYLLABLES = {
    "latin": ["bel", "dor", "fan", "gil", "hem", "jor", "kal", "lun", "mar", "nel", "per", "quin", "ros", "sil", "tam", "ver"],
    "cyrillic": ["бел", "дор", "фан", "гил", "хем", "жор", "кал", "лун", "мар", "нел", "пер", "вин", "рос", "сил", "там", "вер"],
}
ENDINGS = {
    "latin": {"given_f": "a", "given_m": "o", "given_n": "is", "surname": "en"},
    "cyrillic": {"given_f": "а", "given_m": "ин", "given_n": "и", "surname": "ко"},
}
KINDS = ("email", "phone", "card", "ssn", "ip", "given_f", "given_m", "given_n", "surname")
#: Rounds of drawing; what still clashes then (a kind with more entities than surrogates) gets a numbered label.
ROUNDS = 12


def _bound(value: Column, f) -> Column:
    return F.transform(F.array(value), f)[0]


def luhn_sum(digits: Column) -> Column:
    """Digit sum of the Luhn rule; the number holds if it is a multiple of ten."""
    def add(acc: Column, pair: Column) -> Column:
        doubled = pair["c"].cast("int") * 2
        value = F.when(pair["i"] % 2 == 1, doubled - F.when(doubled > 9, 9).otherwise(0)).otherwise(pair["c"].cast("int"))
        return acc + value
    pairs = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(F.filter(pairs, lambda p: p["c"] != ""), F.lit(0), add)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _title(entity: Column) -> Column:
    return F.regexp_extract(entity, rf"^{TITLE}{TITLE_GAP}(?=\p{{Lu}})", 0)


def _is_name(entity: Column) -> Column:
    return entity.rlike(r"^\p{Lu}") & ~entity.contains("@")


def _expression(entities: Column) -> Column:
    """ENTITY, and where names were found after titles, their further mentions: full names and surnames, also in capitals."""
    persons = F.filter(entities, _is_name)
    full = F.transform(persons, lambda e: F.substring(e, F.length(_title(e)) + 1, F.length(e)))
    names = F.array_union(full, F.transform(full, lambda f: F.substring_index(F.substring_index(f, " ", -1), ".", -1)))
    names = F.array_union(names, F.transform(names, F.upper))
    longest = F.reverse(F.array_sort(F.transform(names, lambda x: F.struct(F.length(x).alias("n"), x.alias("x")))))
    quoted = F.array_join(F.transform(longest, lambda x: F.concat(F.lit(r"\Q"), x["x"], F.lit(r"\E"))), "|")
    mention = F.concat(F.lit(f"{ENTITY}|{WORD_BEFORE}(?:"), quoted, F.lit(f"){WORD_AFTER}"))
    return F.when(F.size(persons) > 0, mention).otherwise(ENTITY)


def _one_gender(units: Column) -> Column:
    """A given name of a text is one kind, whatever titles it follows; a title with a gender decides."""
    def kind(u: Column) -> Column:
        alike = F.filter(units, lambda o: o["kind"].startswith("given_") & (o["norm"] == u["norm"]))
        return F.when(u["kind"].startswith("given_"), F.array_min(F.transform(alike, lambda o: o["kind"]))).otherwise(u["kind"])
    return F.transform(units, lambda u: u.withField("kind", kind(u)))


def _units(prefix: Column, entity: Column) -> Column:
    """An entity as (text before, kind, normal form, as written); without kind it stays as it is."""
    def unit(before: Column, kind: Column, norm: Column, raw: Column) -> Column:
        return F.struct(before.alias("before"), kind.alias("kind"), norm.alias("norm"), raw.alias("raw"))

    title = _title(entity)
    gender = F.when(title.rlike(rf"^(?:{FEMALE}){TITLE_GAP}$"), "f").when(title.rlike(rf"^(?:{MALE}){TITLE_GAP}$"), "m").otherwise("n")
    rest = F.substring(entity, F.length(title) + 1, F.length(entity))
    gaps = F.split(rest, WORD)

    def name(words: Column) -> Column:
        return F.transform(words, lambda w, i: unit(
            F.concat(F.when(i == 0, F.concat(prefix, title)).otherwise(""), F.get(gaps, i)),
            F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given_"), gender)), F.lower(w), w,
        ))
    person = _bound(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0)), name)
    number = _digits(entity)
    kind = (
        F.when(entity.contains("@"), "email").when(entity.startswith("+"), "phone")
        .when(entity.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn").when(entity.contains("."), "ip")
        .when(luhn_sum(number) % 10 == 0, "card")
    )
    norm = F.when(kind == "email", F.lower(entity)).when(kind == "ip", entity).otherwise(number)
    return F.when(_is_name(entity), person).otherwise(F.array(unit(prefix, kind, norm, entity)))


def find_entities(texts: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose ``text`` may hold entities, with ``units`` (none, if it holds none) and the ``tail`` after them."""
    return (
        texts.where(F.col("text").rlike(HINT))
        .withColumn("entities", F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
        .withColumn("expression", _expression(F.col("entities")))
        .withColumn("entities", F.when(F.col("expression") == ENTITY, F.col("entities")).otherwise(
            F.regexp_extract_all("text", F.col("expression"), F.lit(0))
        ))
        .withColumn("plain", F.split("text", F.col("expression"), -1))
        .withColumn("units", F.flatten(F.transform("entities", lambda e, i: _units(F.get("plain", i), e))))
        .withColumn("tail", F.element_at("plain", -1))
        .withColumn("units", F.when(F.exists("units", lambda u: u["kind"].startswith("given_")), _one_gender(F.col("units"))).otherwise(F.col("units")))
        .drop("entities", "plain", "expression")
    )


def surrogate(key: str, kind: Column, norm: Column, attempt: int) -> Column:
    """The surrogate of a normal form that the key draws at this attempt."""
    seed = F.concat(F.lit(f"{key}\0{attempt}\0"), kind, F.lit("\0"), norm, F.lit("\0"))

    def byte(i: Column) -> Column:
        digest = F.sha2(F.concat(seed, F.floor(i / 32).cast("string")), 256)
        return F.conv(F.substring(digest, (i % 32 * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")

    def redrawn(text: Column) -> Column:
        def draw(c: Column, i: Column) -> Column:
            out = None
            for letters, such in ALPHABETS:
                value = F.substring(F.lit(letters), byte(i) % len(letters) + 1, F.lit(1))
                out = F.when(c.rlike(such), value) if out is None else out.when(c.rlike(such), value)
            return out.otherwise(c)
        return F.array_join(F.transform(F.split(text, ""), draw), "")

    def name(ending: str) -> Column:
        def written(script: str) -> Column:
            syllables = F.array(*[F.lit(s) for s in SYLLABLES[script]])
            parts = [F.get(syllables, byte(F.lit(i)) % 16) for i in range(3 + attempt // 2)]
            return F.concat(*parts, F.lit(ENDINGS[script][ending]))
        return (
            F.when(norm.rlike(r"\p{IsCyrillic}"), written("cyrillic")).when(norm.rlike(r"\p{IsLatin}"), written("latin"))
            .otherwise(redrawn(norm))
        )

    octets = F.array_join(F.transform(F.split(norm, r"\."), lambda o, i: (
        F.when(F.length(o) == 1, byte(i) % 10).when(F.length(o) == 2, byte(i) % 90 + 10).otherwise(byte(i) % 156 + 100)
    ).cast("string")), ".")
    last_dot = F.length(norm) - F.length(F.substring_index(norm, ".", -1))
    kept = F.length(F.regexp_extract(norm, f"^(?:{COUNTRY}|[0-9]{{3}})", 0))
    body = F.concat(F.substring(norm, 1, 1), redrawn(F.substring(norm, F.lit(2), F.length(norm) - 2)))
    card = _bound(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
    out = (
        F.when(kind == "email", F.concat(redrawn(F.substring(norm, F.lit(1), last_dot - 1)), F.lit("."), F.substring_index(norm, ".", -1)))
        .when(kind == "phone", F.concat(F.substring(norm, F.lit(1), kept), redrawn(F.substring(norm, kept + 1, F.length(norm)))))
        .when(kind == "card", card).when(kind == "ssn", redrawn(norm)).when(kind == "ip", octets)
    )
    for named in ("given_f", "given_m", "given_n", "surname"):
        out = out.when(kind == named, name(named))
    return out


def _family() -> Column:
    """Kinds that must not share a surrogate: parts of names are one."""
    return F.when(F.col("kind").startswith("given_") | (F.col("kind") == "surname"), "name").otherwise(F.col("kind")).alias("family")


def draw_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for distinct (kind, norm): one to one, and never an entity of that kind; names are one kind in this."""
    pending, given = entities, None
    for attempt in range(ROUNDS):
        drawn = pending.withColumn("surrogate", surrogate(key, F.col("kind"), F.col("norm"), attempt)).select("*", _family())
        taken = entities.select(_family(), F.col("norm").alias("surrogate"))
        if given is not None:
            taken = taken.unionAll(given.select(_family(), "surrogate"))
        free = drawn.join(taken, ["family", "surrogate"], "left_anti")
        first = free.groupBy("family", "surrogate").agg(F.min(F.struct("kind", "norm")).alias("of"))
        now = saved(first.select("of.kind", "of.norm", "surrogate"), "surrogates")
        given = now if given is None else given.unionAll(now)
        pending = saved(pending.join(now, ["kind", "norm"], "left_anti"), "pending")
        if pending.isEmpty():
            return given
    label = F.concat(F.lit("["), F.upper("kind"), F.lit("-"), F.substring(F.sha2(F.concat(F.lit(key), F.col("norm")), 256), 1, 32), F.lit("]"))
    return given.unionAll(pending.select("kind", "norm", label.alias("surrogate")))


def _written(kind: Column, raw: Column, value: Column) -> Column:
    """A surrogate in the format of what it replaces."""
    def place(c: Column, i: Column) -> Column:
        at = F.length(_digits(F.substring(raw, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(value, at, F.lit(1))).otherwise(c)
    digits = F.array_join(F.transform(F.split(raw, ""), place), "")
    upper = (raw == F.upper(raw)) & (F.length(raw) > 1)
    cased = F.when(upper, F.upper(value)).otherwise(F.concat(F.upper(F.substring(value, 1, 1)), F.substring(value, F.lit(2), F.length(value))))
    return (
        F.when(value.startswith("["), value).when(kind.isin("phone", "card", "ssn"), digits)
        .when(kind.startswith("given") & (F.length(raw) == 1), F.upper(F.substring(value, 1, 1)))
        .when(kind.startswith("given") | (kind == "surname"), cased)
        .when(upper, F.upper(value)).otherwise(value)
    )


def replaced(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (doc_id long, text string and any others) with surrogates in ``text``, and ``n_replaced``."""
    columns = rows.columns
    others = [c for c in columns if c != "text"]
    found = saved(find_entities(rows).withColumn(
        "row", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text")))
    ).drop("text"), "entities")
    units = found.select("row", F.posexplode("units").alias("i", "u")).select("row", "i", "u.kind", "u.norm", "u.raw").distinct()
    # A given name is one kind in the whole corpus; a title with a gender decides, wherever it stands.
    is_given = F.col("kind").startswith("given_")
    genders = units.where(is_given).groupBy("norm").agg(F.min("kind").alias("gender"))
    units = units.join(saved(genders, "genders"), "norm", "left").withColumn("kind", F.when(is_given, F.col("gender")).otherwise(F.col("kind")))
    units = units.select("row", "i", "kind", "norm", "raw")
    drawn = draw_surrogates(saved(units.where("kind is not null").select("kind", "norm").distinct(), "kinds"), key)
    named = units.join(drawn, ["kind", "norm"], "left").select(
        "row", "i", F.coalesce(_written(F.col("kind"), F.col("raw"), F.col("surrogate")), "raw").alias("s"),
        F.col("surrogate").isNotNull().cast("long").alias("hit"),
    )
    of_row = named.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("new"), F.sum("hit").alias("n_replaced"))
    text = F.concat(F.array_join(F.zip_with("units", "new", lambda u, s: F.concat(u["before"], s["s"])), ""), F.col("tail"))
    changed = found.join(of_row, "row").select(*others, text.alias("text"), "n_replaced")
    none = F.lit(0).cast("long").alias("n_replaced")
    same = rows.where(F.col("text").isNull() | ~F.col("text").rlike(HINT)).select(*others, "text", none)
    same = same.unionAll(found.where(F.size("units") == 0).select(*others, F.col("tail").alias("text"), none))
    return same.unionAll(changed).select(*columns, "n_replaced")


def replace_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, the text with surrogates, and ``n_replaced``. ``key`` decides on the surrogates; keep it secret.

    Kinds: e-mail addresses, phone numbers with a country code, card numbers that pass their check,
    social security numbers, IPv4 addresses, and names after a title, with further mentions of
    the full name or surname in the same text. Null stays null, texts without
    entities stay as they are, repeated rows are treated alike. Extra columns are dropped.
    """
    return replaced(only(docs, doc_id="long", text="string"), key)
