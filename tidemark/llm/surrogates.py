"""Replacing personal data with keyed surrogates, in DataFrame functions only.

Entities are found by one pattern, brought to a canonical form (so all spellings of one e-mail address, phone number
or name are one entity) and mapped by a keyed hash to a value of the same type, gender, script and format.  The
mapping is checked over the whole corpus: two entities never share a surrogate, and no surrogate is an
entity of the corpus; those that collide are drawn again.  Each occurrence is then written in its own format.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import written

# Titles and given names by gender, for names that texts introduce with them.
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Señora Señorita Sra Doña Г-жа Госпожа Κυρία".split(),
    "m": "Mr Sir Herr Monsieur Señor Don Г-н Господин Κύριος".split(),
    "": "Dr Prof Professor".split(),
}
GIVEN_NAMES = {
    "f": (
        "Alice Anna Carmen Catherine Clara Claire Elena Emily Emma Eva Hanna Hannah Helen Ingrid Isabel Jane Jennifer Julia"
        " Julie Karin Laura Linda Lucia Lucía Maria María Marie Martha Mary Monika Patricia Petra Rosa Sabine Sarah Sofia Sophie"
        " Susan Ursula Анна Мария Елена Ольга Наталья Татьяна Ирина Μαρία Ελένη Κατερίνα Άννα"
    ).split(),
    "m": (
        "Alexander Andreas Anton Antonio Carlos Charles Daniel David Diego Felix Fernando François Hans Hugo Jacques James Javier"
        " Jean John Jonas José Juan Jürgen Karl Klaus Louis Lucas Luis Manuel Martin Michael Michel Miguel Paul Pedro Peter Pierre"
        " Robert Stefan Thomas William Wolfgang Иван Пётр Сергей Алексей Дмитрий Андрей Γιώργος Νίκος Δημήτρης Κώστας"
    ).split(),
}
# Letters and endings that surrogate names of a script are made of (f, m, family name).
SCRIPTS = {
    "latin": ("bdfgklmnprstv", "aeio", ("na", "ro", "mer")),
    "cyrillic": ("бвгдклмнпрст", "аеио", ("на", "рий", "нко")),
    "greek": ("βγδκλμνπρστ", "αεηιο", ("να", "ρος", "δης")),
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
PUBLIC_OCTETS = [n for n in range(1, 224) if n not in (10, 100, 127, 169, 172, 192, 198, 203)]

_ALL_TITLES = "|".join(TITLES["f"] + TITLES["m"] + TITLES[""])
_ALL_GIVEN = "|".join(GIVEN_NAMES["f"] + GIVEN_NAMES["m"])
_WORD = r"\p{Lu}[\p{L}\p{M}'’-]*\p{L}(?![\p{L}\p{N}])"
# Groups repeat possessively, each time with what has to follow: the JVM then loops, where it would recurse and, on
# long runs of titles or names, overflow its stack.
_TITLE = rf"(?:(?:{_ALL_TITLES})\.?\x20(?={_WORD}))++"
# Fixed value: labels of a domain name after the first and before the last, at most (names have at most 253 characters).
_LABELS = 125
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Names of secrets may have a longer name before them; a look ahead for the sign skips other words.
_SECRET_HEAD = (
    r"(?=[A-Za-z0-9_-]{2,60}[\x20\t]{0,3}[=:])"
    r"(?i:[a-z0-9_-]{0,40}?(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key))[\x20\t]{0,3}[=:][\x20\t]{0,3}[\"']?"
)

# First digits of card numbers, and their groups as printed; the check digit is tested on what is found.
_ISSUER = r"(?:4|5[0-9]|6|3[0-9]|222[1-9]|22[3-9][0-9]|2[3-6][0-9]{2}|27[01][0-9]|2720)"
_GROUPED = r"[0-9]{4}(?:(?:[\x20-][0-9]{4}){3}(?:[\x20-][0-9]{1,3})?|[\x20-][0-9]{6}[\x20-][0-9]{4,5})"

# In order: of two kinds that begin at one place the first is taken.  Each begins with a test of its first letter, and
# none begins inside an ASCII word or number: most places of a text are passed over at once.
KINDS = {
    "name": (
        rf"(?=\p{{Lu}})(?<!\p{{L}})(?:{_TITLE}{_WORD}|(?:{_ALL_GIVEN})\x20{_WORD})(?:\x20{_WORD})*+"
    ),
    "secret": _SECRET_HEAD + r"(?=[^\s\"']*[0-9])[^\s\"']{5,}[^\s\"'.,;:!?)]",
    "email": (
        r"(?=[A-Za-z0-9._%+-]{1,64}@)[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@"
        rf"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){{0,{_LABELS}}}\.[A-Za-z]{{2,}}"
    ),
    "access": r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": rf"(?=[0-9]{{1,3}}\.)(?<!\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "ssn": r"(?=[0-9]{3}-)(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (
        r"(?=[+(0-9])(?:\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}"
        r"|\([0-9]{3}\)\x20?[0-9]{3}[-.\x20][0-9]{4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4})(?![0-9])"
    ),
    "card": rf"(?=[0-9]{{4}})(?:[0-9]{{13,19}}|(?={_ISSUER}){_GROUPED})(?![0-9A-Za-z])",
    "hex": r"(?=[0-9a-f]{32})(?=[0-9a-f]*[0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])",
}
PATTERN = "(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{pattern})" for pattern in KINDS.values()) + ")"


NAMES = "array<struct<word: string, surrogate: string>>"
# A name's part by itself: not inside another word, nor of an address or a file.
_ALONE = (r"(?<![\p{L}\p{M}\p{N}@._/’'-])\Q", r"\E(?![\p{L}\p{M}\p{N}@_/-])")


def _stream(secret_key: str, kind: Column, value: Column, attempt: Column, size: Column) -> Column:
    """Hex digits that depend on the key and the entity, two for each of ``size`` characters."""
    seed = F.concat_ws("|", F.lit(secret_key), kind, value, attempt.cast("string"))
    blocks = F.sequence(F.lit(0), F.ceil(size / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda k: F.sha2(F.concat_ws("|", seed, k.cast("string")), 256)), "")


def _draw(stream: Column, place: Column, among: int | Column) -> Column:
    """The number from 0 to ``among`` - 1 that the stream has at ``place``."""
    bits = F.conv(F.substring(stream, (place * 2 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")
    return F.coalesce(bits, F.lit(0)) % among


def _pick(stream: Column, place: Column, letters: str) -> Column:
    return F.substring(F.lit(letters), _draw(stream, place, len(letters)) + 1, F.lit(1))


def _same_shape(value: Column, stream: Column, hexadecimal: Column) -> Column:
    """``value`` with each ASCII letter and digit drawn anew, other characters as they are."""

    def drawn(c: Column, place: Column) -> Column:
        lower = F.when(hexadecimal, _pick(stream, place, LETTERS[:6])).otherwise(_pick(stream, place, LETTERS))
        return (
            F.when(c.rlike("[0-9]"), _pick(stream, place, "0123456789"))
            .when(c.rlike("[a-z]"), lower)
            .when(c.rlike("[A-Z]"), F.upper(_pick(stream, place, LETTERS)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), drawn), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum, modulo 10, of digits whose last is the check digit."""
    listed = F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")).cast("array<int>")
    doubled = F.transform(
        listed, lambda d, place: F.when(place % 2 == 0, d).when(d < 5, 2 * d).otherwise(2 * d - 9)
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10


def _card(canon: Column, stream: Column) -> Column:
    """As long, with the same first digit, and with a right check digit exactly if ``canon`` has one."""
    head = F.concat(F.substring(canon, 1, 1), F.substring(_same_shape(canon, stream, F.lit(False)), F.lit(2), F.length(canon) - 2))
    check = (10 - _luhn(F.concat(head, F.lit("0")))) % 10
    wrong = (check + 1 + _draw(stream, F.lit(40), 9)) % 10
    return F.concat(head, F.when(_luhn(canon) == 0, check).otherwise(wrong).cast("string"))


def _iban(canon: Column, stream: Column) -> Column:
    """Of the same country and shape, with right check digits."""
    account = F.substring(_same_shape(canon, stream, F.lit(False)), F.lit(5), F.length(canon))
    country = F.substring(canon, 1, 2)
    moved = F.filter(F.split(F.concat(account, country, F.lit("00")), ""), lambda c: c != "")

    def step(rest: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        value = F.when(digit, c.cast("int")).otherwise(F.ascii(c) - 55)
        return (rest * F.when(digit, 10).otherwise(100) + value) % 97

    check = 98 - F.aggregate(moved, F.lit(0), step)
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), account)


def _address(canon: Column, stream: Column) -> Column:
    """A public address for a public one; one of the same private range for a private one."""
    parts = F.split(canon, r"\.")
    drawn = [_draw(stream, F.lit(4 * k), 256).cast("string") for k in range(3)]
    last = (_draw(stream, F.lit(16), 254) + 1).cast("string")
    public = F.element_at(F.lit(PUBLIC_OCTETS).cast("array<int>"), _draw(stream, F.lit(20), len(PUBLIC_OCTETS)) + 1)
    two_kept = canon.startswith("192.168.") | canon.startswith("169.254.") | canon.rlike(r"^172\.(1[6-9]|2[0-9]|3[01])\.")
    one_kept = canon.startswith("10.") | canon.startswith("127.")
    return (
        F.when(two_kept, F.concat_ws(".", parts[0], parts[1], drawn[1], last))
        .when(one_kept, F.concat_ws(".", parts[0], drawn[0], drawn[1], last))
        .otherwise(F.concat_ws(".", public.cast("string"), drawn[0], drawn[1], last))
    )


def _email(canon: Column, stream: Column, domain_stream: Column) -> Column:
    """A local part of the same shape at a reserved domain that keeps the top level; one domain stays one."""
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    label = _same_shape(F.substring_index(domain, ".", 1), domain_stream, F.lit(False))
    return F.concat(_same_shape(local, stream, F.lit(False)), F.lit("@"), label, F.lit(".example."), F.substring_index(domain, ".", -1))


def _person(kind: Column, stream: Column, attempt: Column) -> Column:
    """A name of syllables of the script, ending as its gender or a family name does."""

    def made(script: str, ending: int) -> Column:
        consonants, vowels, endings = SCRIPTS[script]
        syllables = F.transform(
            F.sequence(F.lit(0), 1 + (attempt / 4).cast("int")),
            lambda k: F.concat(_pick(stream, 2 * k, consonants), _pick(stream, 2 * k + 1, vowels)),
        )
        return F.initcap(F.concat(F.array_join(syllables, ""), F.lit(endings[ending])))

    cases = [(f"{role}_{script}", made(script, k)) for script in SCRIPTS for k, role in enumerate(("given_f", "given_m", "family"))]
    return reduce(lambda whens, case: whens.when(kind == case[0], case[1]), cases[1:], F.when(kind == cases[0][0], cases[0][1]))


def _surrogate(secret_key: str) -> Column:
    """The surrogate of a row (kind, canon, attempt) in canonical form."""
    kind, canon, attempt = F.col("kind"), F.col("canon"), F.col("attempt")
    # Where a short format is used up, later attempts are longer.
    grown = F.concat(canon, F.repeat(F.lit("0"), F.greatest(F.lit(0), attempt - 15)))
    stream = _stream(secret_key, kind, canon, attempt, F.greatest(F.length(grown), F.lit(64)))
    domain = _stream(secret_key, F.lit("domain"), F.substring_index(canon, "@", -1), F.lit(0), F.lit(64))
    number = F.concat((_draw(stream, F.lit(60), 8) + 2).cast("string"), F.substring(_same_shape(canon, stream, F.lit(False)), F.lit(2), F.length(canon)))
    access = F.concat(F.substring(canon, 1, 4), F.substring(_same_shape(canon, stream, F.lit(False)), F.lit(5), F.length(canon)))
    return (
        F.when(kind == "email", _email(canon, stream, domain))
        .when(kind == "ip", _address(canon, stream))
        .when(kind == "card", _card(canon, stream))
        .when(kind == "iban", _iban(canon, stream))
        .when(kind.isin("phone", "ssn"), number)
        .when(kind == "access", access)
        .when(kind.isin("secret", "hex"), _same_shape(grown, stream, canon.rlike("^[0-9a-f]+$")))
        .otherwise(_person(kind, stream, attempt))
    )


def _kind_of(form: Column) -> Column:
    cases = [(F.lit(kind), form.rlike(f"^(?:{pattern})$")) for kind, pattern in KINDS.items()]
    return reduce(lambda whens, case: whens.when(case[1], case[0]), cases[1:], F.when(cases[0][1], cases[0][0]))


def _is_card(form: Column, plain_runs: bool) -> Column:
    """Whether a form of the kind card is one: by issuer, length and check digit; or, with ``plain_runs``, a run of 16 digits."""
    digits = F.regexp_replace(form, "[^0-9]", "")
    checked = digits.rlike(f"^{_ISSUER}") & (_luhn(digits) == 0)
    return checked | form.rlike("^[0-9]{16}$") if plain_runs else checked


def entity_forms(forms: DataFrame, plain_runs: bool = True) -> DataFrame:
    """``form`` with its ``kind``, the ``head`` and ``tail`` that stay around it, and its ``parts``: (kind, canon) of each entity in it.

    A number that only looks like a card has no parts.  A short group after a whole card number is its tail.
    """
    form, kind = F.col("form"), F.col("kind")
    title = F.regexp_extract(form, f"^{_TITLE}", 0)
    head = F.when(kind == "name", title).when(kind == "secret", F.regexp_extract(form, "^" + _SECRET_HEAD, 0)).otherwise(F.lit(""))
    digits = F.regexp_replace(form, "[^0-9]", "")
    first_16 = F.substring(form, 1, 19)
    in_fours = form.rlike(r"^[0-9]{4}(?:[\x20-][0-9]{4}){3}[\x20-]")
    whole, tailed = F.col("_whole"), F.col("_tailed")
    tail = F.when(tailed, F.expr("substring(form, 20)")).otherwise(F.lit(""))
    body = F.expr("substring(form, length(head) + 1)")
    canon = (
        F.when(kind == "email", F.lower(form))
        .when(tailed, F.regexp_replace(first_16, "[^0-9]", ""))
        .when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.substring(digits, -10, 10))
        .when(kind == "iban", F.regexp_replace(form, r"\x20", ""))
        .when(kind == "secret", body)
        .otherwise(form)
    )
    words = F.split(body, r"\x20")
    script = F.when(body.rlike(r"\p{IsCyrillic}"), "cyrillic").when(body.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    by_title = F.when(F.regexp_extract("head", r"^[^.\x20]*", 0).isin(TITLES["f"]), "f").otherwise("m")
    first = words[0]
    gender = F.when(first.isin(GIVEN_NAMES["f"]), "f").when(first.isin(GIVEN_NAMES["m"]), "m").otherwise(by_title)

    def role(word: Column, place: Column) -> Column:
        """The first of several words is a given name, and so are listed ones between it and the last."""
        between = (place > 0) & (place < F.size(words) - 1)
        return (
            F.when((place == 0) & (F.size(words) > 1), F.concat(F.lit("given_"), gender))
            .when(between & word.isin(GIVEN_NAMES["f"]), "given_f")
            .when(between & word.isin(GIVEN_NAMES["m"]), "given_m")
            .otherwise("family")
        )

    person = F.transform(
        words,
        lambda word, place: F.struct(
            F.concat_ws("_", role(word, place), script).alias("kind"),
            F.lower(word).alias("canon"),
            word.alias("word"),
        ),
    )
    one = F.array(F.struct(kind.alias("kind"), canon.alias("canon"), F.lit(None).cast("string").alias("word")))
    sound = (kind != "card") | tailed | whole
    parts = F.when(kind == "name", person).when(sound, one).otherwise(F.slice(one, 1, 0))
    kinds = (
        forms.withColumn("kind", _kind_of(form))
        .withColumn("_whole", (kind == "card") & _is_card(form, plain_runs))
        .withColumn("_tailed", (kind == "card") & ~whole & in_fours & _is_card(first_16, plain_runs))
    )
    return kinds.withColumn("head", head).withColumn("tail", tail).withColumn("parts", parts).drop("_whole", "_tailed")


def surrogate_table(entities: DataFrame, secret_key: str, most_attempts: int = 64) -> DataFrame:
    """A ``surrogate`` for each row of ``entities`` (kind, canon; distinct), no two alike and none an entity.

    All entities are drawn once, then only those that collide: of entities with one surrogate the smallest keeps
    it.  The table is written in every round, and there is another one only while something collides.
    """
    drawn = written(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(secret_key)), "surrogates")
    for _ in range(most_attempts):
        # One comparison for spelling: names are told apart without regard to case.
        shown = F.lower("surrogate")
        keepers = drawn.groupBy(shown.alias("shown")).agg(F.min(F.struct("kind", "canon")).alias("keeper"), F.count("*").alias("n"))
        taken = entities.select(F.lower("canon").alias("shown")).distinct().withColumn("taken", F.lit(True))
        state = drawn.withColumn("shown", shown).join(keepers, "shown").join(taken, "shown", "left")
        again = (F.col("n") > 1) & (F.struct("kind", "canon") != F.col("keeper")) | F.col("taken").isNotNull()
        state = written(state.withColumn("again", again).select("kind", "canon", "attempt", "surrogate", "again"), "surrogates")
        redrawn = state.where("again")
        if redrawn.isEmpty():
            return state.select("kind", "canon", "surrogate")
        redrawn = redrawn.select("kind", "canon", (F.col("attempt") + 1).alias("attempt")).withColumn("surrogate", _surrogate(secret_key))
        drawn = written(state.where("not again").select(*drawn.columns).union(redrawn), "surrogates")
    raise ValueError("surrogates still collide after all attempts")


def _in_format(form: Column, surrogate: Column) -> Column:
    """``form`` with its last letters and digits replaced by those of ``surrogate``, signs and spaces kept."""
    kept = F.length(F.regexp_replace(form, "[^A-Za-z0-9]", "")) - F.length(surrogate)

    def placed(c: Column, place: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(form, F.lit(1), place + 1), "[^A-Za-z0-9]", ""))
        inside = c.rlike("[A-Za-z0-9]") & (before > kept)
        return F.when(inside, F.substring(surrogate, before - kept, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(form, ""), placed), "")


def replacements(forms: DataFrame, secret_key: str, plain_runs: bool = True) -> DataFrame:
    """``form``, its ``replacement``, whether it is an ``entity``, and its ``names``, for each row of ``forms`` (form; distinct).

    What is no entity replaces itself; names are the words of a person's name with their surrogates.
    """
    known = written(entity_forms(forms, plain_runs), "forms")
    exploded = known.select("form", "kind", "head", "tail", F.posexplode("parts").alias("place", "part"))
    entities = exploded.select("part.kind", "part.canon").distinct()
    table = surrogate_table(entities, secret_key).withColumnRenamed("kind", "part_kind").withColumnRenamed("canon", "part_canon")
    joined = exploded.join(
        table, (F.col("part.kind") == F.col("part_kind")) & (F.col("part.canon") == F.col("part_canon"))
    )
    one = F.col("chosen")[0]["surrogate"]
    shown = F.when(F.col("form") == F.upper("form"), F.upper(one)).otherwise(one)
    body = F.expr("substring(form, 1, length(form) - length(tail))")
    others = known.where(F.size("parts") == 0).select("form", F.col("form").alias("replacement"), F.lit(False).alias("entity"), F.lit(None).cast(NAMES).alias("names"))
    return (
        joined.groupBy("form", "kind", "head", "tail")
        .agg(F.sort_array(F.collect_list(F.struct("place", "part.word", "surrogate"))).alias("chosen"))
        .select(
            "form",
            F.when(F.col("kind") == "name", F.concat("head", F.array_join(F.transform("chosen", lambda c: c["surrogate"]), " ")))
            .when(F.col("kind") == "secret", F.concat("head", one))
            .when(F.col("kind") == "email", shown)
            .when(F.col("kind").isin("phone", "card", "ssn", "iban"), F.concat(_in_format(body, one), "tail"))
            .otherwise(one)
            .alias("replacement"),
            F.lit(True).alias("entity"),
            F.when(F.col("kind") == "name", F.transform("chosen", lambda c: F.struct(c["word"], c["surrogate"]))).cast(NAMES).alias("names"),
        )
        .union(others)
    )


def replace_personal_data(docs: DataFrame, secret_key: str, text_col: str = "text", plain_runs: bool = True) -> DataFrame:
    """``docs`` with every entity in ``text_col`` replaced, and ``n_entities``; all other columns as they are.

    Words that are part of a person's name in a text are replaced where they stand alone in it, too, and counted.

    The same entity has the same surrogate everywhere, different ones have different surrogates.  NULL texts stay
    NULL and texts without an entity stay as they are, both with n_entities 0; repeated rows are treated alike;
    an empty table gives an empty one.  ``docs`` must not have a column ``n_entities``.

    A number counts as a card by issuer, printed groups and check digit; with ``plain_runs`` so does any run of 16 digits.

    Only texts with entities are moved: each travels with its first entity, to the surrogate of that and back to
    its row.  An entity that a third of all texts have is a skewed join key, which adaptive execution splits.
    """
    if "n_entities" in docs.columns:
        raise ValueError("docs has a column n_entities")
    text = F.col(text_col)
    found = F.coalesce(text.rlike(PATTERN), F.lit(False))
    others = [name for name in docs.columns if name != text_col]
    numbered = docs.where(found).select(F.monotonically_increasing_id().alias("_row"), F.struct(*docs.columns).alias("_doc"))
    each = F.posexplode(F.regexp_extract_all(F.col(f"_doc.{text_col}"), F.lit(PATTERN), F.lit(0)))
    occurrences = written(
        numbered.select("_row", "_doc", each.alias("_place", "form")).select(
            "_row", F.when(F.col("_place") == 0, F.col("_doc")).alias("_doc"), "_place", "form"
        ),
        "occurrences",
    )
    forms = occurrences.select("form").distinct()
    chosen = F.sort_array(F.collect_list(F.struct("_place", "replacement", "entity", "names")))
    rows = (
        occurrences.join(replacements(forms, secret_key, plain_runs), "form")
        .groupBy("_row")
        .agg(F.first("_doc", ignorenulls=True).alias("_doc"), chosen.alias("_chosen"))
    )
    between = F.split(F.col(f"_doc.{text_col}"), PATTERN, -1)
    # One more piece of text than entities: the last has nothing after it.
    joined = F.array_join(
        F.transform(F.col("_told"), lambda piece, k: F.concat(piece, F.coalesce(F.get(F.col("_chosen"), k)["replacement"], F.lit("")))), ""
    )
    # Between the entities, words that are parts of the document's names are those persons again.
    names = F.array_distinct(F.flatten(F.filter(F.transform("_chosen", lambda c: c["names"]), lambda names: names.isNotNull())))

    def alone(name: Column) -> Column:
        return F.concat(F.lit(_ALONE[0]), name["word"], F.lit(_ALONE[1]))

    def told(piece: Column) -> Column:
        start = F.struct(piece.alias("text"), F.lit(0).alias("n"))
        return F.aggregate(
            F.col("_names"),
            start,
            lambda done, name: F.struct(
                F.regexp_replace(done["text"], alone(name), name["surrogate"]).alias("text"),
                (done["n"] + F.regexp_count(done["text"], alone(name))).alias("n"),
            ),
        )

    mentions = F.aggregate("_pieces", F.lit(0), lambda n, piece: n + piece["n"])
    changed = (
        rows.withColumn("_between", between)
        .withColumn("_names", names)
        .withColumn("_pieces", F.transform("_between", told))
        .withColumn("_told", F.transform("_pieces", lambda piece: piece["text"]))
        .select(
            *(F.col("_doc")[name].alias(name) for name in others),
            joined.alias(text_col),
            (F.size(F.filter("_chosen", lambda c: c["entity"])) + mentions).alias("n_entities"),
        )
    )
    order = [*docs.columns, "n_entities"]
    unchanged = docs.where(~found).withColumn("n_entities", F.lit(0))
    return unchanged.select(*order).union(changed.select(*order))
