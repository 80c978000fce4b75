"""Personal data and secrets replaced by keyed surrogates, in DataFrame functions only.

Entities are found by patterns. Each distinct entity gets one surrogate, drawn from a keyed hash of its
kind and canonical form, so mentions of it agree in every document (coreference) and can't be undone
without the key. A surrogate has the type and format of what it stands for: digits for digits and
letters for letters, addresses that are valid, card numbers with a valid check digit where the
original has one, names of the gender that the title tells, in the name's script. Drawing goes
on in rounds until no two entities share a surrogate and none equals an entity found in the texts. Where that format
has no room (left), surrogates become longer with each round, so every entity gets one.

Texts are split at the entities and joined again with the surrogates between, so replacements never meet
each other. Equal texts are worked out once.

Defined cases: a null text stays null; texts without entities stay as they are; an empty table stays empty; other columns are
kept; repeated rows get equal results.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import aside, mark_hot, put_back, split_join, stored

TITLES = {"m": ("Mr", "Herr", "Señor", "Monsieur", "Господин", "Κύριος"), "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа", "Κυρία")}
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_SECRET = r"(?i:password|passwd|pwd|secret|token|api_?key) ?[=:] ?[\"']?"

#: Kind and pattern, in the order in which they are tried.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
             r"|(?<![0-9A-Za-z(+-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}[ -]?){3}[0-9]{1,7}(?![0-9A-Za-z])",
    "key": r"(?<![0-9A-Za-z])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "secret": rf"(?<![0-9A-Za-z]){_SECRET}[^\s\"']+",
    "hex": r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])",
    "person": rf"(?<!\p{{L}})(?:{_TITLE})\.? {_NAME}(?: {_NAME})?",
}
PATTERN = "|".join(PATTERNS.values())
#: A text without any of these has no entity.
TRIGGER = rf"[0-9@]|(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}|{_SECRET}|AKIA[0-9A-Z]{{16}}|[0-9a-f]{{32}}"
#: Rounds in which surrogates keep the length of their form; from then on each round makes them longer.
SAME_LENGTH = 4
#: Rounds without any new surrogate before giving up; a draw whose space grows never comes to that.
ROUNDS = 30

LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
GIVEN = {
    ("latin", "m"): ("Adrian", "Bruno", "Conrad", "Daniel", "Edgar", "Felix", "Gustav", "Hugo"),
    ("latin", "f"): ("Alma", "Bettina", "Clara", "Dora", "Elena", "Flora", "Greta", "Hanna"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Инна", "Лариса", "Марина"),
    ("greek", "m"): ("Αλέξης", "Γιώργος", "Κώστας", "Νίκος"), ("greek", "f"): ("Άννα", "Ελένη", "Μαρία", "Σοφία"),
}
SYLLABLES = {
    "latin": ("ba", "do", "fel", "gar", "hin", "ka", "lor", "men", "nil", "per", "ro", "sto", "tam", "ul", "vin", "wes"),
    "cyrillic": ("ба", "до", "вел", "гор", "зин", "ка", "лор", "мен", "нил", "пер", "ро", "сто", "там", "уль", "вин", "лес"),
    "greek": ("βα", "δο", "φελ", "γαρ", "κα", "λορ", "μεν", "νιλ", "περ", "ρο", "στο", "ταμ"),
}


def entities(text: Column) -> Column:
    """The entities of a text in order, as they stand."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def kind_of(value: Column) -> Column:
    """The kind of an entity: the first pattern that matches all of it."""
    pairs = [(k, value.rlike(rf"\A(?:{p})\z")) for k, p in PATTERNS.items()]
    return functools.reduce(lambda rest, kp: F.when(kp[1], F.lit(kp[0])).otherwise(rest), reversed(pairs), F.lit("secret"))


def canonical(kind: Column, value: Column) -> Column:
    """The form that all mentions of one entity share."""
    digits = F.regexp_replace(value, "[^0-9+]", "")
    gender = F.when(value.rlike(rf"\A(?:{'|'.join(TITLES['m'])})\b"), F.lit("m")).otherwise(F.lit("f"))
    return (F.when(kind == "email", F.lower(value)).when(kind.isin("phone", "card", "ssn"), digits)
            .when(kind == "secret", F.regexp_replace(value, rf"\A{_SECRET}", ""))
            .when(kind == "person", F.concat(gender, F.lit(":"), F.regexp_replace(value, rf"\A(?:{_TITLE})\.? ", ""))).otherwise(value))


def _draw(seed: Column, i: Column, n: int) -> Column:
    """A keyed number from 0 to n - 1; i counts the draws of one entity."""
    return F.pmod(F.conv(F.substr(F.sha2(F.concat_ws("|", seed, i.cast("string")), 256), F.lit(1), F.lit(12)), 16, 10).cast("long"), F.lit(n)).cast("int")


def _pick(values: str, seed: Column, i: Column) -> Column:
    return F.substr(F.lit(values), _draw(seed, i, len(values)) + 1, F.lit(1))


def _each(value: Column, f: Callable[[Column, Column], Column]) -> Column:
    """f(character, position from 0) of every character, joined; an empty value stays empty."""
    spots = F.filter(F.sequence(F.lit(0), F.length(value)), lambda i: i < F.length(value))
    return F.array_join(F.transform(spots, lambda i: f(F.substr(value, i + 1, F.lit(1)), i)), "")


def _alike(value: Column, seed: Column, keep: Callable[[Column], Column]) -> Column:
    """Another character of the same class for each, ASCII for those of any script; keep(position) says which stay."""
    return _each(value, lambda c, i: F.when(keep(i), c).when(c.rlike(r"\p{Lu}"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", seed, i))
                 .when(c.rlike(r"[\p{L}\p{M}]"), _pick(LETTERS, seed, i)).when(c.rlike(r"\p{N}"), _pick(DIGITS, seed, i)).otherwise(c))


def _more(values: str, seed: Column, n: int) -> Column:
    """n characters of values; their draws count down from -1."""
    return F.concat(F.lit(""), *[_pick(values, seed, F.lit(-k)) for k in range(1, n + 1)])


def _luhn(digits: Column) -> Column:
    """The sum that ends in 0 for a valid card number."""
    n = F.length(digits)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda s, i: s + F.transform(
        F.array(F.coalesce(F.substr(digits, n - i + 1, F.lit(1)).try_cast("int"), F.lit(0))),
        lambda d: F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2))[0])


def _name(words: Column, gender: Column, seed: Column, attempt: int) -> Column:
    """As many words as the name has: a given name of the gender before a family name, which has one more syllable with each attempt."""
    script = F.when(words.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(words.rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))

    def family(kind: str) -> Column:
        parts = F.array(*map(F.lit, SYLLABLES[kind]))
        n = len(SYLLABLES[kind])
        # draw 9 is the given name's
        base = F.concat(*[F.element_at(parts, _draw(seed, F.lit(k + (k > 8)), n) + 1) for k in range(3 + attempt)])
        ending = F.when(gender == "f", F.lit("ова")).otherwise(F.lit("ов")) if kind == "cyrillic" else F.lit("")
        return F.concat(F.initcap(base), ending)

    def given(kind: str) -> Column:
        return functools.reduce(lambda rest, g: F.when(gender == g, F.element_at(F.array(*map(F.lit, GIVEN[kind, g])), _draw(seed, F.lit(9), len(GIVEN[kind, g])) + 1)).otherwise(rest), "mf", F.lit(None).cast("string"))

    both = [F.when(words.contains(" "), F.concat_ws(" ", given(k), family(k))).otherwise(family(k)) for k in ("cyrillic", "greek", "latin")]
    return F.when(script == "cyrillic", both[0]).when(script == "greek", both[1]).otherwise(both[2])


def surrogate(kind: Column, form: Column, key: str, attempt: int) -> Column:
    """A surrogate of a canonical form, itself in canonical form.

    A form without anything to draw another of its class for is drawn from letters and digits, and longer with each
    attempt; the others have their own length for SAME_LENGTH attempts. So the surrogates of a form never run out.
    """
    seed = F.concat_ws("|", F.lit(key), kind, form, F.lit(str(attempt)))
    longer = max(0, attempt - SAME_LENGTH + 1)
    end = F.length(form) - F.length(F.substring_index(form, ".", -1))
    octets = [F.when(F.lit(k) == 0, _draw(seed, F.lit(0), 222) + 1).when(F.lit(k) == 3, _draw(seed, F.lit(3), 254) + 1).otherwise(_draw(seed, F.lit(k), 256)).cast("string") for k in range(4)]
    private, small = form.startswith("10.") | form.startswith("192.168."), form.startswith("192.168.")
    address = F.when(private & (~small | F.lit(longer > 0)), F.concat_ws(".", F.lit("10"), *octets[1:])).when(small, F.concat_ws(".", F.lit("192.168"), *octets[2:])).otherwise(F.concat_ws(".", *octets))
    # a range that is used up goes on in the next: 10.0.0.0/8, then the private and the documentation range of IPv6
    groups = [F.lower(F.hex(_draw(seed, F.lit(k), 65_536))) for k in range(6)]
    wide = F.concat_ws(":", F.when(private, F.lit("fd00:db8")).otherwise(F.lit("2001:db8")), *groups)
    if longer:
        address = F.when(small & F.lit(longer <= SAME_LENGTH), address).otherwise(wide)
    new_email = _each(form, lambda c, i: F.when((i >= end) | c.isin("@", "."), c).otherwise(_pick(LETTERS, seed, i)))
    bare_email = ~F.substr(form, F.lit(1), end).rlike("[a-z0-9]")
    email = F.when(bare_email, F.concat(_more(LETTERS, seed, attempt), new_email))
    email = email.otherwise(F.concat(_more(LETTERS, seed, longer), new_email) if longer else _alike(form, seed, lambda i: i >= end))
    phone = _alike(form, seed, lambda i: i < F.when(form.startswith("+"), F.lit(2)).otherwise(F.lit(0)))
    card = F.concat(_alike(form, seed, lambda i: i == 0), _more(DIGITS, seed, longer))
    check = F.pmod(-_luhn(F.concat(F.substr(card, F.lit(1), F.length(card) - 1), F.lit("0"))), F.lit(10)).cast("string")
    gender, name = F.substr(form, F.lit(1), F.lit(1)), F.substr(form, F.lit(3), F.length(form))
    hexed = F.concat(_each(form, lambda c, i: _pick("0123456789abcdef", seed, i)), _more("0123456789abcdef", seed, longer))
    plain = _each(form, lambda c, i: _pick(LETTERS + DIGITS, seed, i))
    secret = F.when(~form.rlike(r"[\p{L}\p{M}\p{N}]"), F.concat(plain, _more(LETTERS + DIGITS, seed, attempt)))
    secret = secret.otherwise(F.concat(plain, _more(LETTERS + DIGITS, seed, longer)) if longer else _alike(form, seed, lambda i: F.lit(False)))
    return (F.when(kind == "email", email).when(kind == "ip", address)
            .when(kind == "phone", F.concat(phone, _more(DIGITS, seed, longer)))
            .when(kind == "card", F.when(_luhn(form) % 10 == 0, F.concat(F.substr(card, F.lit(1), F.length(card) - 1), check)).otherwise(card))
            .when(kind == "key", _each(form, lambda c, i: F.when(i < 4, c).otherwise(_pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", seed, i))))
            .when((kind == "hex") | form.rlike(r"\A[0-9a-f]+\z") & (kind == "secret"), hexed)
            .when(kind == "person", F.concat(gender, F.lit(":"), _name(name, gender, seed, attempt)))
            .when(kind == "secret", secret).otherwise(F.concat(_alike(form, seed, lambda i: F.lit(False)), _more(DIGITS, seed, longer))))


def in_format(kind: Column, value: Column, chosen: Column) -> Column:
    """A surrogate written like the mention it replaces."""
    digits = F.length(F.regexp_replace(value, "[^0-9+]", ""))
    poured = _each(value, lambda c, i: F.when(c.rlike("[0-9+]"), F.substr(chosen, F.length(F.regexp_replace(F.substr(value, F.lit(1), i + 1), "[^0-9+]", "")), F.lit(1))).otherwise(c))
    poured = F.concat(poured, F.substr(chosen, digits + 1, F.length(chosen)))
    # a longer address has the additional letters in front
    more = F.greatest(F.length(chosen) - F.length(value), F.lit(0))
    cased = _each(value, lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substr(chosen, more + i + 1, F.lit(1)))).otherwise(F.substr(chosen, more + i + 1, F.lit(1))))
    cased = F.concat(F.substr(chosen, F.lit(1), more), cased)
    lead = F.when(kind == "secret", F.regexp_extract(value, rf"\A{_SECRET}", 0)).when(kind == "person", F.regexp_extract(value, rf"\A(?:{_TITLE})\.? ", 0)).otherwise(F.lit(""))
    bare = F.when(kind == "person", F.substr(chosen, F.lit(3), F.length(chosen))).otherwise(chosen)
    return F.when(kind == "email", cased).when(kind.isin("phone", "card", "ssn"), poured).otherwise(F.concat(lead, bare))


def assign(forms: DataFrame, key: str, draw: Callable[[Column, Column, str, int], Column] = surrogate) -> DataFrame:
    """(kind, form, surrogate) for distinct (kind, form): one-to-one, and no surrogate is a form of the kind."""
    forms = stored(forms, "forms")
    left, done, idle = forms, None, 0
    for attempt in itertools.count():
        drawn = left.withColumn("surrogate", draw(F.col("kind"), F.col("form"), key, attempt))
        free = drawn.join(forms.select("kind", F.col("form").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        # of entities that drew the same, the smallest form has it
        won = stored(free.groupBy("kind", "surrogate").agg(F.min("form").alias("form")).select("kind", "form", "surrogate"), "won")
        done = won if done is None else done.unionByName(won)
        left = stored(left.join(won, ["kind", "form"], "left_anti"), "left")
        if left.isEmpty():
            return done
        idle = idle + 1 if won.isEmpty() else 0
        if idle == ROUNDS:
            raise RuntimeError(f"entities are left without a surrogate of their own, and {ROUNDS} rounds drew none")


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with entities of the text column replaced, and _entities: how many."""
    columns = docs.columns
    docs = docs.select(F.col(text), aside(docs, text))
    flagged = docs.withColumn("_found", F.when(F.col(text).rlike(TRIGGER), entities(F.col(text))))
    has = F.coalesce(F.size("_found"), F.lit(0)) > 0
    keyed = docs.where(F.col(text).rlike(TRIGGER)).select(F.sha2(text, 256).alias("_text"), entities(F.col(text)).alias("_found")).where(F.size("_found") > 0)
    texts = stored(keyed.groupBy("_text").agg(F.count("*").alias("_rows"), F.any_value("_found").alias("_found")), "entities")
    mentions = texts.select("_text", F.posexplode("_found").alias("at", "value"))
    values = mentions.groupBy("value").agg(F.count("*").alias("mentions")).withColumn("kind", kind_of(F.col("value")))
    values = stored(values.withColumn("form", canonical(F.col("kind"), F.col("value"))), "values")
    chosen = assign(values.select("kind", "form").distinct(), key)
    known = values.join(chosen, ["kind", "form"]).withColumn("new", in_format(F.col("kind"), F.col("value"), F.col("surrogate")))
    known = stored(mark_hot(known.select("value", "mentions", "new"), "mentions"), "surrogates")
    met = split_join(mentions, known, ["value"])
    # an array per text, as long as the text has entities
    new = met.groupBy("_text").agg(F.array_sort(F.collect_list(F.struct("at", "new"))).alias("_new"))
    new = texts.select("_text", "_rows").join(new, "_text").select("_text", "_rows", F.transform("_new", lambda x: x["new"]).alias("_new"))
    new = stored(mark_hot(new, "_rows"), "replacements")
    some = split_join(flagged.where(has).withColumn("_text", F.sha2(text, 256)), new, ["_text"])
    parts = F.zip_with(F.split(F.col(text), PATTERN, -1), F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    some = some.withColumn(text, F.array_join(parts, "")).withColumn("_entities", F.size("_new"))
    none = flagged.where(~has).withColumn("_entities", F.lit(0))
    return some.unionByName(none, allowMissingColumns=True).select(*put_back(columns, text), "_entities")
