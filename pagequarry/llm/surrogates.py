"""Surrogates for personal data: keyed replacements that keep type, format, script and gender.

Found entities are brought to a canonical form (digits of a number, lower-case address, name without title), and the
surrogate depends on that form and a secret key only, so an entity has one surrogate in the whole corpus, written in the
format of each mention. Numbers, addresses and secrets go through a keyed permutation that maps digits to digits and
letters to letters of their kind: different entities cannot share a surrogate. Names take a given name of the gender their
title tells, and a permuted surname in the same script.

Distinctness is checked all the same: the distinct entities with their surrogates are one distributed table, and where two
share a surrogate, or a surrogate is itself an entity of the corpus, one of them takes its next surrogate, until none is
left. These exceptions go to their documents as a list per text, sent where it is measured to fit, else joined.

Edge cases: a null text stays null with 0 entities; repeated rows are treated alike; all other columns pass through,
those named like an output are replaced; an empty table gives an empty result.
"""

import hashlib
import hmac
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.joins import fits_broadcast
from ..plans.storage import written
from .arrow import add_columns, pieces, texts_of
from .shipping import map_batches

ROUNDS = 6
# characters that are permuted at once; of longer texts the numbers would get too large
BLOCK = 200
# a whole run, however long, so that no number is cut; each character is looked at once
NUMBER = re.compile(r"[0-9+(][0-9 ().+-]{6,}")
NUMBERS = (
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)")),
    ("phone", re.compile(r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<!\d)\d{3}[-.]\d{3}[-.]\d{4}(?!\d)")),
    ("id", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("card", re.compile(r"(?<!\d)\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?!\d)|(?<!\d)\d{13,19}(?!\d)")),
)
LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.){1,8}[A-Za-z]{2,24}")
ASSIGNED = re.compile(r"[:=]\s{0,3}[\"']?([^\s\"':=,;]{6,})")
SECRET_NAME = re.compile(r"(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s{0,3}\Z", re.IGNORECASE)
# not after a letter or digit, so that a refused match takes no real one along
SECRET = re.compile(r"(?<![^\W_])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{20,})")
IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
# Titles by the gender they tell.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Sra", "Señora", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Sr", "Señor", "Monsieur", "Господин", "Κύριος"),
}
_GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}
_LETTER = r"[^\W\d_]"
PERSON = re.compile(
    r"(?:" + "|".join(sorted(_GENDER, key=len, reverse=True)) + rf")\.?[ ]((?:{_LETTER}[\w'’-]{{1,40}}[ ]?){{1,3}})"
)
# Given names by script and gender.
GIVEN = {
    ("latin", "f"): ("Anna", "Clara", "Diana", "Elena", "Greta", "Irina", "Julia", "Laura", "Maria", "Nina", "Paula", "Sofia"),
    ("latin", "m"): ("Adam", "Bruno", "Daniel", "Emil", "Felix", "Hugo", "Ivan", "Leon", "Martin", "Oscar", "Paul", "Viktor"),
    ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Иван", "Лев", "Олег", "Павел", "Роман"),
    ("greek", "f"): ("Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Νίκη", "Σοφία"),
    ("greek", "m"): ("Γιώργος", "Κώστας", "Νίκος", "Πέτρος", "Σπύρος", "Χρήστος"),
}
ALPHABETS = ("aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ")
_CLASS = {c: a for alphabet in ALPHABETS for a in (alphabet, alphabet.upper()) for c in a}
_CLASS |= {c: "0123456789" for c in "0123456789"}


def _pseudo(key: bytes, message: str, below: int) -> int:
    """A keyed number below a bound of any size."""
    size = below.bit_length() // 8 + 9
    out = b""
    while len(out) < size:
        out += hmac.digest(key, f"{len(out)}|{message}".encode(), "sha256")
    return int.from_bytes(out[:size], "big") % below


def permute(key: bytes, tweak: str, text: str, hexadecimal: bool = False) -> str:
    """A keyed one-to-one map of texts of one shape: each character goes to one of its own class, and characters of no
    class stay. Two halves of the changeable places take turns in shifting each other."""
    if len(text) > BLOCK:
        return _permute_blocks(key, tweak, text, hexadecimal)
    classes = [("0123456789abcdef" if hexadecimal and c in "0123456789abcdef" else _CLASS.get(c, "")) for c in text]
    places = [i for i, a in enumerate(classes) if a]
    shape = "".join("x" if hexadecimal and a == "0123456789abcdef" else a[0] if a else c for a, c in zip(classes, text, strict=True))
    halves = places[::2], places[1::2]
    bounds, values = [], []
    for half in halves:
        bound, value = 1, 0
        for i in half:
            bound *= len(classes[i])
            value = value * len(classes[i]) + classes[i].index(text[i])
        bounds.append(bound)
        values.append(value)
    for turn in range(ROUNDS):
        own, other = turn % 2, 1 - turn % 2
        values[own] = (values[own] + _pseudo(key, f"{tweak}|{shape}|{turn}|{values[other]}", bounds[own])) % bounds[own]
    out = list(text)
    for half, value in zip(halves, values, strict=True):
        for i in reversed(half):
            value, digit = divmod(value, len(classes[i]))
            out[i] = classes[i][digit]
    return "".join(out)


def _permute_blocks(key: bytes, tweak: str, text: str, hexadecimal: bool) -> str:
    """``permute`` of a text of any length in linear time. Each block's map depends on all blocks before it, and a second
    pass from the other end makes it depend on those after it; both passes are one-to-one."""
    blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
    for turn in range(2):
        seen = hmac.new(key, f"blocks|{turn}|{len(text)}|{tweak}".encode(), "sha256")
        out = []
        for block in blocks:
            out.append(permute(key, f"{tweak}|{seen.copy().hexdigest()}", block, hexadecimal))
            seen.update(block.encode())
        blocks = out[::-1]
    return "".join(blocks)


def _check_digit(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def script_of(text: str) -> str:
    low = text.lower()
    if any("а" <= c <= "я" for c in low):
        return "cyrillic"
    return "greek" if any("α" <= c <= "ω" for c in low) else "latin"


def surrogate(kind: str, canonical: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate of an entity in canonical form; ``attempt`` counts those that were already taken."""
    value = canonical
    for _ in range(attempt + 1):
        value = _once(kind, value, key)
    return value


def _once(kind: str, value: str, key: bytes) -> str:
    if kind == "card":
        body, last = value[:-1], int(value[-1])
        new = permute(key, kind, body)
        return new + str((_check_digit(new) + last - _check_digit(body)) % 10)
    if kind == "ip":
        number = "".join(f"{int(part):02x}" for part in value.split("."))
        new = permute(key, kind, number, hexadecimal=True)
        return ".".join(str(int(new[i : i + 2], 16)) for i in (0, 2, 4, 6))
    if kind == "phone":
        # the first digits, country or area, tell the type of the number
        return value[:2] + permute(key, f"{kind}|{value[:2]}", value[2:])
    if kind == "email":
        local, _, domain = value.partition("@")
        name, _, ending = domain.rpartition(".")
        return f"{permute(key, kind + domain, local)}@{permute(key, kind + ending, name)}.{ending}"
    if kind.startswith("person"):
        words = value.split(" ")
        script, gender = script_of(value), kind.partition("-")[2]
        names = GIVEN[script, gender]
        given = names[_pseudo(key, f"given|{gender}|{words[0]}", len(names))].lower()
        if len(words) == 1:
            return permute(key, kind, value)
        return " ".join([given, *(permute(key, f"{kind}|{words[0]}", w) for w in words[1:])])
    return permute(key, kind, value, hexadecimal=bool(re.fullmatch(r"[0-9a-f]+", value)))


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, canonical`` of the entities of a text, in order and without overlaps."""
    found = []
    at = text.find("@")
    while at >= 0:
        local, domain = LOCAL.search(text, max(0, at - 64), at), DOMAIN.match(text, at + 1)
        if local and domain:
            found.append((local.start(), domain.end(), "email", text[local.start() : domain.end()].lower()))
        at = text.find("@", at + 1)
    for m in ASSIGNED.finditer(text):
        if SECRET_NAME.search(text, max(0, m.start() - 24), m.start()):
            found.append((m.start(1), m.end(1), "secret", m.group(1)))
    found += [(m.start(), m.end(), "secret", m.group()) for m in SECRET.finditer(text)]
    for m in NUMBER.finditer(text):
        for kind, pattern in NUMBERS:
            for hit in pattern.finditer(text, m.start(), m.end()):
                if not (text[hit.start() - 1 : hit.start()].isalnum() or text[hit.end() : hit.end() + 1].isalnum()):
                    canonical = hit.group() if kind == "ip" else re.sub(r"\D", "", hit.group())
                    found.append((hit.start(), hit.end(), kind, canonical))
    if any(c.isdigit() for c in text[:1]) or re.search("[0-9]", text):
        for m in IBAN.finditer(text):
            if not text[m.start() - 1 : m.start()].isalnum():
                found.append((m.start(), m.end(), "iban", m.group().replace(" ", "")))
    for m in PERSON.finditer(text):
        words = m.group(1).split()
        names = words[: next((i for i, w in enumerate(words) if not w[0].isupper()), len(words))]
        if names and not text[m.start() - 1 : m.start()].isalnum():
            name = " ".join(names)
            title = m.group().split(" ")[0].rstrip(".")
            found.append((m.start(1), m.start(1) + len(name), f"person-{_GENDER[title]}", name.lower()))
    kept, end = [], 0
    for entity in sorted(found, key=lambda e: (e[0], -e[1])):
        if entity[0] >= end:
            kept.append(entity)
            end = entity[1]
    return kept


def render(mention: str, kind: str, new: str) -> str:
    """A canonical surrogate in the format of a mention: its separators and its case."""
    if kind in ("card", "phone", "id", "iban"):
        characters = iter(new)
        return "".join(next(characters) if c.isalnum() else c for c in mention)
    if kind == "ip" or kind == "secret":
        return new
    if kind.startswith("person"):
        words = mention.split(" ")
        return " ".join(w.upper() if o.isupper() and len(o) > 1 else w.capitalize() for w, o in zip(new.split(" "), words, strict=True))
    return new.upper() if mention.isupper() else new


@lru_cache(maxsize=50_000)
def _kept_surrogate(kind: str, canonical: str, key: bytes, attempt: int) -> str:
    return surrogate(kind, canonical, key, attempt)


def replace_entities(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with surrogates, and the number of mentions."""
    parts, end, entities = [], 0, find_entities(text)
    for start, stop, kind, canonical in entities:
        # long ones would fill the memory if kept
        made = _kept_surrogate if len(canonical) <= BLOCK else surrogate
        new = made(kind, canonical, key, attempts.get((kind, canonical), 0))
        parts += [text[end:start], render(text[start:stop], kind, new)]
        end = stop
    return "".join([*parts, text[end:]]), len(entities)


def mentions(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_t, kind, canonical``: the distinct entities of each text, known by a digest of it."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "_text"):
                rows = [
                    (t, kind, canonical)
                    for t, content in zip(piece.column("_t").to_pylist(), texts_of(piece, "_text"), strict=True)
                    for kind, canonical in {(e[2], e[3]) for e in find_entities(content)}
                ]
                columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(columns, names=["_t", "kind", "canonical"])

    chosen = docs.where(F.col(text).isNotNull()).select(F.md5(F.col(text)).alias("_t"), F.col(text).alias("_text"))
    return map_batches(chosen, run, "_t string, kind string, canonical string")


def resolve_collisions(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, canonical, attempt`` of the entities that may not take their first surrogate."""

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "canonical", "attempt")), strict=True)
            made = [surrogate(kind, canonical, key, attempt) for kind, canonical, attempt in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("kind", "canonical", "attempt")), pa.array(made, pa.string())],
                names=["kind", "canonical", "attempt", "new"],
            )

    state = entities.withColumn("attempt", F.lit(0).cast("bigint"))
    while True:
        made = written(map_batches(state, run, "kind string, canonical string, attempt long, new string"), "surrogates")
        # whoever has tried more often stays, then the least
        first = F.min(F.struct(-F.col("attempt"), F.col("canonical").alias("owner"))).alias("_first")
        shared = made.groupBy("kind", "new").agg(F.count(F.lit(1)).alias("n"), first).where(F.col("n") > 1)
        losers = made.join(shared.select("kind", "new", "_first.owner"), ["kind", "new"]).where(F.col("owner") != F.col("canonical"))
        real = entities.select("kind", F.col("canonical").alias("new"))
        hits = made.join(real, ["kind", "new"], "left_semi")
        again = losers.select("kind", "canonical").unionByName(hits.select("kind", "canonical")).distinct()
        again = written(again.withColumn("_again", F.lit(1)), "collisions")
        if again.isEmpty():
            return made.where(F.col("attempt") > 0).select("kind", "canonical", "attempt")
        state = made.join(again, ["kind", "canonical"], "left").select(
            "kind", "canonical", (F.col("attempt") + F.coalesce("_again", F.lit(0))).alias("attempt")
        )


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The documents with surrogates in the place of personal data; adds ``n_entities``."""
    found = written(mentions(docs, text), "mentions")
    exceptions = resolve_collisions(written(found.select("kind", "canonical").distinct(), "entities"), key)
    per_text = found.join(exceptions, ["kind", "canonical"]).groupBy("_t").agg(
        F.collect_list(F.struct("kind", "canonical", "attempt")).alias("_exceptions")
    )
    per_text = written(per_text, "exceptions")
    others = [c for c in docs.columns if c != "n_entities"]
    keyed = docs.select(*others).withColumn("_t", F.md5(F.col(text)))
    joined = keyed.join(F.broadcast(per_text) if fits_broadcast(per_text) else per_text, "_t", "left")

    def make(batch):
        out, counts = [], []
        for content, special in zip(batch.column(text).to_pylist(), batch.column("_exceptions").to_pylist(), strict=True):
            attempts = {(e["kind"], e["canonical"]): e["attempt"] for e in special or []}
            new, n = (None, 0) if content is None else replace_entities(content, key, attempts)
            out.append(new)
            counts.append(n)
        return {text: pa.array(out, pa.string()), "n_entities": pa.array(counts, pa.int64())}

    added = {text: T.StringType(), "n_entities": T.LongType()}
    return add_columns(joined, text, added, make).select(*others, "n_entities")
