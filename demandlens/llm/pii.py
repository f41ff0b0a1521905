"""Personal data replaced by keyed, type-consistent surrogates.

Found are e-mail addresses, IPv4 addresses, telephone numbers, account numbers (13
to 19 digits), social security numbers, secrets (hexadecimal strings of 32 or more,
and values assigned to names such as ``token``) and persons (after a title, or a
known given name before a capitalised word; then every further mention of their
names in the same document).

A surrogate is drawn from a keyed hash of the entity, so an entity has the same
surrogate in every document, and nobody without the key can draw it.  It has the
entity's form: digits, letters, case and separators stay in place; given names keep
gender and script; account numbers keep their first digit and whether their check
digit holds; addresses move to ranges and domains that nobody can own (240.0.0.0/4,
``example``); telephone numbers of the American form keep their country code and
get the fictional exchange 555.  What is drawn anew has a larger space with each
attempt: e-mail addresses, names and secrets grow longer, and American telephone
numbers get an area code that can't be dialled.

Distinct entities must have distinct surrogates, and no surrogate may be a real
entity of the corpus.  Both are checked over all entities at once: each clash is
drawn anew until none is left.  Only the entities drawn anew must be looked up when
texts are rewritten; all others follow from the key.

A null text stays null; a text without findings stays as it is.  Repeated rows get
equal rows.  An empty table gives an empty result.  Input columns named as a count
column are replaced; all others are kept.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from demandlens.llm.common import drop_clashes, materialize

COUNTS = {"email": "n_emails", "ip": "n_ips", "phone": "n_phones", "account": "n_accounts", "ssn": "n_ssns",
          "secret": "n_secrets", "name": "n_names"}
#: Documents with entities that were drawn anew, up to which these are broadcast; else it is a shuffle join.
MAX_BROADCAST_DOCUMENTS = 200_000

# Titles with their gender, and given names by script and gender.
TITLES = {"Mr": "m", "Mister": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n",
          "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mademoiselle": "f",
          "Señor": "m", "Señora": "f", "господин": "m", "госпожа": "f", "Господин": "m", "Госпожа": "f"}
GIVEN = {
    ("latin", "f"): ["Alice", "Amelia", "Anna", "Beatrice", "Camille", "Carla", "Charlotte", "Clara", "Diana", "Elena",
                     "Emma", "Eva", "Helena", "Ingrid", "Irene", "Julia", "Laura", "Lucia", "Maria", "Martha",
                     "Nadia", "Nora", "Olivia", "Paula", "Rosa", "Sarah", "Sofia", "Teresa", "Vera", "Victoria"],
    ("latin", "m"): ["Adam", "Albert", "Anton", "Bruno", "Carlos", "Daniel", "David", "Diego", "Edward", "Felix",
                     "Franz", "George", "Henry", "Hugo", "Ivan", "James", "John", "Karl", "Leon", "Louis",
                     "Lucas", "Martin", "Michael", "Oscar", "Paul", "Peter", "Robert", "Simon", "Thomas", "Victor"],
    ("latin", "n"): ["Alex", "Andrea", "Charlie", "Jordan", "Kim", "Morgan", "Robin", "Sam", "Sasha", "Taylor"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Надежда", "Ольга", "Полина", "Юлия"],
    ("cyrillic", "m"): ["Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Михаил", "Николай", "Олег", "Павел", "Сергей"],
    ("cyrillic", "n"): ["Женя", "Саша", "Валя", "Шура"],
}
ONSETS = {"latin": "b br c d f g gr h k l m n p r s st t v w".split(),
          "cyrillic": "б в г д ж к л м н п р с т ф".split()}
VOWELS = {"latin": "a e i o u".split(), "cyrillic": "а е и о у".split()}
ENDINGS = {"latin": "er man son ton berg ley well ford".split(), "cyrillic": "ов ев ин ский ко".split()}

GENDER_OF = {name.lower(): gender for (_, gender), names in GIVEN.items() for name in names}
_UP, _LOW = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
_CAP = rf"(?:[{_UP}][{_LOW}]+|[{_UP}]{{2,}})(?:-[{_UP}][{_LOW}{_UP}]+)?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PERSON = re.compile(rf"(?<!\w)({'|'.join(TITLES)})(\.?[ \t]+)({_CAP}(?:[ \t]+{_CAP}){{0,2}})(?!\w)")
#: Looks ahead, so that every capitalised word is tried as the first of a pair.
PAIR = re.compile(rf"(?<!\w)(?=({_CAP})[ \t]+({_CAP})(?!\w))")
NAME = re.compile(_CAP)
LOCAL, DOMAIN = re.compile(r"[A-Za-z0-9._%+\-]"), re.compile(r"[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}")
DIGIT = re.compile(r"\d")
NUMBERS = [
    ("ip", re.compile(rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)")),
    ("phone", re.compile(r"(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .\-]?\d{2,4}){2,4}(?!\w)"
                         r"|(?<!\w)\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\w)|(?<![\w\-])\d{3}-\d{3}-\d{4}(?![\w\-])")),
    ("ssn", re.compile(r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])")),
    ("account", re.compile(r"(?<![\w.])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3})(?!\w|\.\d)")),
]
HEX = re.compile(r"(?<!\w)(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,}(?!\w)")
ASSIGNED = re.compile(r"(?i)(?<!\w)(?:token|secret|password|passwd|api[_\-]?key|access[_\-]?key|auth)\s{0,4}[=:]\s{0,4}"
                      r"[\"']?([A-Za-z0-9+/_\-]{12,})")


#: Rounds of drawing anew after which a form counts as crowded out.
MAX_ROUNDS = 40


class Found(NamedTuple):
    start: int
    end: int
    kind: str  # a name's kind also names script and gender
    entity: str  # canonical form: equal for all mentions of one entity


def canonical(kind: str, surface: str) -> str:
    if kind in ("phone", "account", "ssn"):
        return re.sub(r"\D", "", surface)
    if kind == "secret":
        return surface.lower() if re.fullmatch("[0-9a-fA-F]+", surface) else surface
    return surface.lower()


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("@")
    while at >= 0:
        start = at
        while start and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1)
        while start < at and text[start] in "._%+-":
            start += 1
        if domain and start < at:
            yield start, domain.end()
        at = text.find("@", at + 1)


def _script(word: str) -> str:
    return "cyrillic" if re.search("[А-Яа-яЁё]", word) else "latin"


def _names(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, entity) of the words of persons' names, and of every later mention of those words."""
    roles: dict[str, str] = {}
    mentions = []
    if any(title in text for title in TITLES):
        mentions += [(m.group(3), TITLES[m.group(1)]) for m in PERSON.finditer(text)]
    mentions += [(f"{m.group(1)} {m.group(2)}", "") for m in PAIR.finditer(text)
                 if m.group(1).lower() in GENDER_OF and m.group(2).lower() not in GENDER_OF]
    for full, title in mentions:
        words = NAME.findall(full)
        given, family = (words[:-1], words[-1]) if len(words) > 1 else ([], words[0])
        for word in given:
            gender = GENDER_OF.get(word.lower(), title or "n")
            roles.setdefault(word, f"given-{_script(word)}-{gender}")
        roles.setdefault(family, f"family-{_script(family)}")
    roles |= {w.upper(): role for w, role in roles.items() if w.upper() not in roles}
    if roles:
        words = "|".join(re.escape(w) for w in sorted(roles, key=len, reverse=True))
        for m in re.finditer(rf"(?<!\w)(?:{words})(?!\w)", text):
            yield m.start(), m.end(), roles[m.group()], m.group().lower()


def find(text: str) -> list[Found]:
    """Non-overlapping findings in order; of overlapping ones the more specific kind stays."""
    found: list[Found] = []

    def add(start: int, end: int, kind: str, entity: str | None = None) -> None:
        found.append(Found(start, end, kind, canonical(kind, text[start:end]) if entity is None else entity))

    if "@" in text:
        for start, end in _emails(text):
            add(start, end, "email")
    if DIGIT.search(text):
        for m in HEX.finditer(text):
            add(*m.span(), "secret")
        for kind, pattern in NUMBERS:
            for m in pattern.finditer(text):
                add(*m.span(), kind)
    if "=" in text or ":" in text:
        for m in ASSIGNED.finditer(text):
            add(*m.span(1), "secret")
    for start, end, kind, entity in _names(text):
        add(start, end, kind, entity)
    # where findings overlap, the one of the earlier kind stays
    order = sorted(range(len(found)), key=lambda i: (found[i].start, i))
    out: list[int] = []
    for i in order:
        if out and found[i].start < found[out[-1]].end:
            if i < out[-1] and (len(out) < 2 or found[i].start >= found[out[-2]].end):
                out[-1] = i
        else:
            out.append(i)
    return [found[i] for i in out]


class Draws:
    """Endless keyed draws for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.seed = hashlib.blake2b(f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass"), key=key).digest()
        self.pool, self.block = 0, 0
        self.size = 1

    def below(self, n: int) -> int:
        if self.size < n << 64:  # 64 spare bits keep the draw even
            block = hashlib.blake2b(self.block.to_bytes(8, "little"), key=self.seed[:64]).digest()
            self.pool, self.size, self.block = int.from_bytes(block, "little"), 1 << 512, self.block + 1
        self.pool, out = divmod(self.pool, n)
        self.size //= n
        return out

    def of(self, options):
        return options[self.below(len(options))]

    def like(self, text: str) -> str:
        """Digits for digits and letters for letters."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(self.of("0123456789"))
            elif c.isalpha():
                letter = self.of("abcdefghijklmnopqrstuvwxyz")
                out.append(letter.upper() if c.isupper() else letter)
            else:
                out.append(c)
        return "".join(out)

    def more(self, attempt: int) -> str:
        """A letter for each attempt, so that there are always enough surrogates."""
        return "".join(self.of("abcdefghijklmnopqrstuvwxyz") for _ in range(attempt))


def luhn(digits: str) -> int:
    """What the check digit is off by: 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The canonical form of an entity's surrogate."""
    draws = Draws(key, kind, entity, attempt)
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        labels = domain.split(".")
        top = labels[-1] if labels[-1] in ("com", "org", "net") else "com"
        # users of one domain share their surrogate domain
        of_domain = Draws(key, "domain", domain, 0)
        above = labels[:-2] or labels[:1]
        return f"{draws.like(local)}{draws.more(attempt)}@{'.'.join([*map(of_domain.like, above), 'example', top])}"
    if kind == "ip":
        return ".".join(map(str, [240 + draws.below(15), draws.below(256), draws.below(256), 1 + draws.below(254)]))
    if kind == "phone":
        new = draws.like(entity)
        if len(entity) == 11 and entity[0] == "1":
            # the exchange 555 has ten million numbers; no area code begins with 0 or 1
            return "1" + new[1:4] + "555" + new[7:] if attempt < 2 else "1" + draws.of("01") + new[2:]
        if len(entity) == 10:  # the same without the country's number
            return new[:3] + "555" + new[6:] if attempt < 2 else draws.of("01") + new[1:]
        return entity[0] + new[1:] if len(entity) > 10 else new
    if kind == "ssn":
        return "9" + draws.like(entity[1:])
    if kind == "account":
        body = entity[0] + draws.like(entity[1:-1])
        right = next(d for d in "0123456789" if not luhn(body + d))
        return body + (right if not luhn(entity) else draws.of([d for d in "0123456789" if d != right]))
    if kind == "secret":
        if re.fullmatch("[0-9a-f]+", entity):
            return "".join(draws.of("0123456789abcdef") for _ in entity)
        return draws.like(entity) + draws.more(attempt)
    role, script, *gender = kind.split("-")
    if role == "given":
        # each further attempt adds a name, so there are always enough
        return "-".join(draws.of(GIVEN[script, gender[0]]).lower() for _ in range(attempt // 2 + 1))
    syllables = [draws.of(ONSETS[script]) + draws.of(VOWELS[script]) for _ in range(2 + attempt // 2)]
    return "".join(syllables) + draws.of(ENDINGS[script])


def dressed(kind: str, new: str, surface: str) -> str:
    """``new`` in the layout and case of the mention."""
    if kind in ("phone", "account", "ssn"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in surface)
    if kind == "ip" or (kind == "secret" and not re.fullmatch("[0-9a-fA-F]+", surface)):
        return new
    if kind.startswith(("given", "family")):
        return new.upper() if surface.isupper() and len(surface) > 1 else new.title()
    if surface.isupper():
        return new.upper()
    if len(new) == len(surface):
        return "".join(n.upper() if s.isupper() else n for n, s in zip(new, surface, strict=True))
    return new


def rewrite(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, dict[str, int]]:
    """The text with surrogates, and the number of findings by kind."""
    parts, at, counts = [], 0, dict.fromkeys(COUNTS, 0)
    for f in find(text):
        new = surrogate(key, f.kind, f.entity, attempts.get((f.kind, f.entity), 0))
        parts += [text[at:f.start], dressed(f.kind, new, text[f.start:f.end])]
        at = f.end
        counts[f.kind if f.kind in counts else "name"] += 1
    return "".join([*parts, text[at:]]), counts


def mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, kind, entity): each document's distinct entities."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    schema = StructType([docs.schema["id"]]).add("kind", StringType()).add("entity", StringType())

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *e) for i, t in enumerate(batch.column("text"))
                    for e in sorted({(f.kind, f.entity) for f in find(t.as_py())})]
            at, kinds, entities = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(at, pa.int64())),
                                              pa.array(kinds, pa.string()), pa.array(entities, pa.string())],
                                             names=schema.names)

    return docs.mapInArrow(found, schema)


def draw(entities: DataFrame, key: bytes) -> DataFrame:
    """``entities`` (kind, entity, attempt) with their surrogates."""
    def drawn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(key, *row) for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(new, pa.string())],
                                             names=["kind", "entity", "attempt", "surrogate"])

    return (entities.select("kind", "entity", "attempt")
            .mapInArrow(drawn, "kind string, entity string, attempt long, surrogate string"))


def distinct_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt, surrogate) without clashes.

    Of entities with one surrogate the one drawn first keeps it, then the smallest;
    a surrogate that is an entity itself is drawn anew.  A name's role counts as its
    kind, whatever its gender, so that no two persons come to share a name.  Only
    clashing entities are drawn again.  If some still clash after ``MAX_ROUNDS``, a
    form's fixed space is as good as full, and an error names it.
    """
    role = F.substring_index("kind", "-", 1)
    named: DataFrame = materialize(draw(entities.withColumn("attempt", F.lit(0).cast("long")), key), "pii-named")
    real = materialize(entities.select(role.alias("r"), F.col("entity").alias("e")).distinct(), "pii-real")
    for _ in range(MAX_ROUNDS):
        keyed = named.withColumn("role", role)
        first = (keyed.groupBy("role", "surrogate")
                 .agg(F.min(F.struct("attempt", "kind", "entity")).alias("first"), F.count("*").alias("n"))
                 .where("n > 1").select(F.col("role").alias("r"), F.col("surrogate").alias("s"), "first"))
        doubled = (keyed.join(first, (F.col("role") == F.col("r")) & (F.col("surrogate") == F.col("s")))
                   .where(~((F.col("first.kind") == F.col("kind")) & (F.col("first.entity") == F.col("entity")))))
        taken = keyed.join(real, (F.col("role") == F.col("r")) & (F.col("surrogate") == F.col("e")), "left_semi")
        clashes = materialize(doubled.select("kind", "entity").union(taken.select("kind", "entity")).distinct(), "pii-clashes")
        if clashes.isEmpty():
            return named
        again = named.join(clashes, ["kind", "entity"], "left_semi").withColumn("attempt", F.col("attempt") + 1)
        rest = named.join(clashes, ["kind", "entity"], "left_anti").select("kind", "entity", "attempt", "surrogate")
        named = materialize(rest.union(draw(again, key)), "pii-named")
    crowded = [r["kind"] for r in clashes.select("kind").distinct().collect()]  # a few kinds
    raise ValueError(f"{', '.join(sorted(crowded))}: more distinct entities of a form than its surrogates can tell apart")


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with rewritten texts and the number of findings of each kind."""
    if not 1 <= len(key) <= 64:
        raise ValueError("the key must have 1 to 64 bytes")
    docs = drop_clashes(docs, [*COUNTS.values(), "__id", "__anew"])
    said = materialize(mentions(docs, id_col, text_col), "pii-mentions")
    entities = materialize(said.select("kind", "entity").distinct(), "pii-entities")
    anew = materialize(distinct_surrogates(entities, key).where("attempt > 0").drop("surrogate"), "pii-anew")
    # a document's list is no longer than its own findings
    lists = materialize(said.join(anew, ["kind", "entity"]).groupBy(F.col("id").alias("__id"))
                        .agg(F.collect_set(F.array("kind", "entity", F.col("attempt").cast("string")))
                             .alias("__anew")), "pii-lists")
    known = lists.count()
    if known:
        side = F.broadcast(lists) if known <= MAX_BROADCAST_DOCUMENTS else lists
        joined = docs.join(side, F.col(id_col).eqNullSafe(F.col("__id")), "left").drop("__id")
    else:
        joined = docs.withColumn("__anew", F.lit(None).cast(ArrayType(ArrayType(StringType()))))
    kept = docs.columns
    schema = StructType(list(docs.schema.fields))
    for name in COUNTS.values():
        schema = schema.add(name, LongType())

    def rewritten(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewriter = functools.partial(rewrite, key=key)
        for batch in batches:
            texts, counts = [], []
            for text, anew_of in zip(batch.column(text_col), batch.column("__anew"), strict=True):
                attempts = {(kind, entity): int(attempt) for kind, entity, attempt in anew_of.as_py() or []}
                new, found = (None, dict.fromkeys(COUNTS, 0)) if text.as_py() is None else rewriter(
                    text.as_py(), attempts=attempts)
                texts.append(new)
                counts.append(found)
            arrays = [pa.array(texts, batch.column(c).type) if c == text_col else batch.column(c) for c in kept]
            arrays += [pa.array([c[kind] for c in counts], pa.int64()) for kind in COUNTS]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return joined.mapInArrow(rewritten, schema)
