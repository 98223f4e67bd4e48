"""Surrogates for personal data: keyed, type-consistent, distinct, coreferent.

A scan finds entities. The distinct ones, and only they, are given surrogates:
a keyed hash proposes one of the same type, script, gender and format; one
that another entity took, or that is itself an entity of the texts, is
proposed again. So two entities never get one surrogate, and an entity has the
same one wherever it stands; a surname is one under titles of any gender, and
only its ending follows them. A second scan writes them into the texts, in the
letter case and punctuation of each place.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesguard.session import cut

# Titles by gender, and given names, surnames and syllables by script, from which names are made.
TITLES = {
    ("latin", "m"): ["Mr", "Herr", "Señor", "Monsieur", "Signor"],
    ("latin", "f"): ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "Mademoiselle", "Signora"],
    ("latin", "n"): ["Mx", "Dr", "Prof"],
    ("cyrillic", "m"): ["господин", "г-н"],
    ("cyrillic", "f"): ["госпожа", "г-жа"],
    ("greek", "m"): ["κύριος", "κύριε"],
    ("greek", "f"): ["κυρία"],
}
GIVEN = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon",
                     "Martin", "Oskar", "Paul", "Robert", "Simon", "Thomas", "Victor"],
    ("latin", "f"): ["Alice", "Berta", "Clara", "Diana", "Elena", "Flora", "Hanna", "Irene", "Julia", "Karla", "Laura",
                     "Maria", "Nora", "Olga", "Paula", "Rosa", "Sofia", "Vera"],
    ("latin", "n"): ["Alex", "Charlie", "Dana", "Kim", "Noa", "Robin", "Sascha", "Toni"],
    ("cyrillic", "m"): ["Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Николай", "Павел", "Сергей"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Мария", "Нина", "Ольга", "Татьяна"],
    ("greek", "m"): ["Αντώνης", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Κατερίνα", "Μαρία", "Σοφία"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fal", "gor", "hal", "ker", "lan", "mor", "nel", "ost", "per", "ran", "sel", "tor", "ven", "wal"],
    "cyrillic": ["бар", "вел", "гор", "дан", "жел", "зор", "кал", "лен", "мор", "нес", "пол", "рам", "сол", "тур"],
    "greek": ["βασ", "γαλ", "δημ", "ζερ", "καλ", "λαμ", "μαν", "νικ", "παν", "ραλ", "σταθ", "τσακ"],
}
ENDINGS = {("latin", "m"): "", ("latin", "f"): "", ("latin", "n"): "", ("cyrillic", "m"): "ов",
           ("cyrillic", "f"): "ова", ("greek", "m"): "ίδης", ("greek", "f"): "ίδου"}

GENDER = {t: k for k, ts in TITLES.items() for t in ts}
_TITLE = "|".join(sorted(map(re.escape, GENDER), key=len, reverse=True))


def _letters(upper: bool) -> str:
    """The letters of one case in the Latin, Greek and Cyrillic blocks, as ranges of a character class."""
    out: list[list[int]] = []
    for block in ((0x41, 0x250), (0x370, 0x530), (0x1E00, 0x2000)):
        for c in range(*block):
            if chr(c).isalpha() and (chr(c).isupper() or chr(c).istitle() if upper else chr(c).islower()):
                if out and out[-1][1] == c - 1:
                    out[-1][1] = c
                else:
                    out.append([c, c])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in out)


_MARK = "[\u0300-\u036f]*"
_UP, _LOW = f"[{_letters(True)}]{_MARK}", f"(?:[{_letters(False)}]{_MARK})"
#: A name: a capital and small letters, capitals inside (McDonald), one before an apostrophe (O'Brien),
#: and parts joined by hyphens (Jean-Luc), which are one name.
_PART = rf"(?:{_UP}['’])?{_UP}{_LOW}+(?:{_UP}{_LOW}+)*"
_NAME = rf"{_PART}(?:-{_PART})*"
#: What a name word may be again in capitals or as it was: whole words with apostrophes and hyphens inside.
_WORD = re.compile(r"\w+(?:['’-]\w+)*")
#: After these a capitalised word that is also a name begins a question or a date, not a mention.
_NOT_AFTER = re.compile(r" +(?:\d|(?:[Yy]ou|[Hh]e|[Ss]he|[Ii]t|[Ww]e|[Tt]hey|I)\b)")
_BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: (type, trigger a text must hold, pattern; group "e" is the entity). Earlier ones win where two overlap.
PATTERNS = [
    ("secret", re.compile(r"(?i)token|secret|passw|key"), re.compile(
        r"(?i)(?:token|secret|passwd|password|api[_-]?key|access[_-]?key|private[_-]?key)\s*[=:]\s*[\"']?"
        r"(?P<e>[A-Za-z0-9+/_-]{12,}={0,2})")),
    ("email", re.compile("@"), re.compile(r"(?P<e>\w[\w.%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})")),
    ("iban", re.compile(r"[A-Z]{2}\d\d"), re.compile(r"(?<!\w)(?P<e>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)")),
    ("ip", re.compile(r"\d\.\d"), re.compile(rf"(?<![\w.])(?P<e>(?:{_BYTE}\.){{3}}{_BYTE})(?!\w|\.\d)")),
    ("card", re.compile(r"\d{4}"), re.compile(
        r"(?<![\w.-])(?P<e>\d{13,19}|\d{4}(?P<s>[ -])\d{4}(?P=s)\d{4}(?P=s)\d{1,7}|\d{4}([ -])\d{6}\3\d{5})(?!\w)")),
    ("ssn", re.compile(r"\d-\d\d-\d"), re.compile(r"(?<![\w-])(?P<e>\d{3}-\d{2}-\d{4})(?![\w-])")),
    ("phone", re.compile(r"\d{3}"), re.compile(
        r"(?<![\w.])(?P<e>\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|"
        r"\d{3}[.-]\d{3}[.-]\d{4})(?!\w)")),
    ("name", re.compile(_TITLE), re.compile(rf"(?<!\w)(?P<t>{_TITLE})\.? +(?P<e>{_NAME}(?: {_NAME}){{0,2}})(?!\w)")),
]
FOUND = "kind string, norm string"
#: A text without any of these has no entity: an at sign; digits as numbers have them, or a title; a word of
#: secrets (in any case) in a text with a sign of assignment. Most places fail at the first character.
WORDS, ASSIGN = ("token", "secret", "passw", "key"), ("=", ":")
NUMBER_OR_TITLE = (rf"(?=[\p{{Nd}}{''.join(sorted({t[0] for t in GENDER}))}])"
                   rf"(?:\p{{Nd}}(?:[\p{{Nd}}.-]\p{{Nd}}|(?<=[A-Z]{{2}}\p{{Nd}})\p{{Nd}})|{_TITLE})")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def script(word: str) -> str:
    c = ord(word[0])
    return "greek" if 0x370 <= c < 0x400 else "cyrillic" if 0x400 <= c < 0x530 else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Entities of a text as (start, end, kind, norm), in order, not overlapping.

    ``kind`` holds what the surrogate must share: the type, and for names the
    part, script and gender. ``norm`` is the entity without letter case and
    punctuation. Name words after a title are entities of their own, the last
    one a surname, so ``Mrs Anna Keller`` and ``Ms Keller`` share it. Words that
    a title introduces are found wherever else they stand in the text, as they
    are or in capitals, with the kind of their first titled place; but not those
    that the text also has in lower case, as common words are, nor before a
    number or a pronoun (``May 5``, ``Will you``).
    """
    out: list[tuple[int, int, str, str]] = []
    for kind, trigger, pattern in PATTERNS:
        if not trigger.search(text):
            continue
        for m in pattern.finditer(text):
            a, b = m.span("e")
            value = m["e"]
            if kind == "name":
                _, gender = GENDER[m["t"]]
                parts = list(re.finditer(r"\S+", value))
                for k, w in enumerate(parts):
                    part = "surname" if k == len(parts) - 1 else "given"
                    out.append((a + w.start(), a + w.end(), f"{part}:{script(w[0])}:{gender}", w[0].lower().replace("’", "'")))
            elif kind in ("card", "ssn", "phone"):
                digits = re.sub(r"\D", "", value)
                kind_ = f"card:{int(luhn(digits))}" if kind == "card" else kind
                out.append((a, b, kind_, digits))
            elif kind == "iban":
                out.append((a, b, kind, value.replace(" ", "")))
            elif kind == "secret":
                mixed = value != value.lower() and value != value.upper()
                out.append((a, b, "secret:mixed" if mixed else "secret", value if mixed else value.lower()))
            else:
                out.append((a, b, kind, value.lower()))
    order = {k: n for n, (k, _, _) in enumerate(PATTERNS)} | {"surname": 99, "given": 99}
    chosen: list[tuple[int, int, str, str]] = []
    for e in sorted(out, key=lambda e: (order[e[2].split(":")[0]], e[0])):
        k = bisect.bisect_left(chosen, e)
        if (k == 0 or chosen[k - 1][1] <= e[0]) and (k == len(chosen) or e[1] <= chosen[k][0]):
            chosen.insert(k, e)
    names: dict[str, tuple[str, str]] = {}
    for a, b, kind, norm in chosen:
        if kind.startswith(("given:", "surname:")):
            word = text[a:b].replace("’", "'")
            names.setdefault(word, (kind, norm))
            names.setdefault(word.upper(), (kind, norm))
    if names:
        common = {w for w in {n.lower() for n in names} if re.search(rf"(?<!\w){re.escape(w)}(?!\w)", text)}
        for m in _WORD.finditer(text):
            plain = m[0].replace("’", "'")
            # Of ``Keller's`` or ``O'Brien-Bau`` the longest beginning that is a name.
            for end in [len(plain), *(k for k in range(len(plain) - 1, 0, -1) if plain[k] in "'-")]:
                word = plain[:end]
                if word in names and word.lower() not in common and not _NOT_AFTER.match(text, m.start() + end):
                    e = (m.start(), m.start() + end, *names[word])
                    k = bisect.bisect_left(chosen, e)
                    if (k == 0 or chosen[k - 1][1] <= e[0]) and (k == len(chosen) or e[1] <= chosen[k][0]):
                        chosen.insert(k, e)
                        break
    return chosen


def may_hold(text: Column) -> Column:
    """Whether a text can hold an entity at all, told without Python."""
    either = lambda c, parts: reduce(lambda x, y: x | y, [F.contains(c, F.lit(p)) for p in parts])
    some = F.contains(text, F.lit("@")) | text.rlike(NUMBER_OR_TITLE) | (either(text, ASSIGN) & either(F.lower(text), WORDS))
    return F.coalesce(some, F.lit(False))


class Stream:
    """Keyed pseudo-random choices for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, norm: str, attempt: int):
        self.seed, self.n, self.left = hmac.new(key, f"{kind}\0{norm}\0{attempt}".encode(), hashlib.sha256).digest(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left = hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest()
            self.n += 1
        x, self.left = self.left[:8], self.left[8:]
        return int.from_bytes(x, "big") % n

    def pick(self, items):
        return items[self.below(len(items))]

    def like(self, value: str) -> str:
        """Letters for letters and digits for digits; hexadecimal stays so."""
        letters = "abcdef" if re.fullmatch("[0-9a-f]*", value) else "abcdefghijklmnopqrstuvwxyz"
        return "".join(self.pick("0123456789") if c.isdigit() else self.pick(letters) if c.islower() else
                       self.pick(letters.upper()) if c.isupper() else c for c in value)


def propose(key: bytes, kind: str, norm: str, attempt: int) -> str:
    """The surrogate's norm that ``attempt`` proposes."""
    s, (what, *more) = Stream(key, kind, norm, attempt), kind.split(":")
    if what == "email":
        local, _, domain = norm.partition("@")
        labels = domain.split(".")
        # The domain's letters hang on the domain alone, so addresses that share one still do.
        d = Stream(key, "domain", domain, attempt // 64)
        return s.like(local) + "@" + ".".join([*map(d.like, labels[:-1]), labels[-1]])
    if what == "ip":
        spans = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
        wide = attempt >= 64                             # so few addresses of this format are free
        return ".".join(str(lo + s.below(n)) for lo, n in (((0, 256) if wide else spans[len(x)]) for x in norm.split(".")))
    if what == "card":
        body = norm[0] + "".join(s.pick("0123456789") for _ in norm[1:-1])
        right = next(d for d in "0123456789" if luhn(body + d))
        return body + (right if more[0] == "1" else s.pick([d for d in "0123456789" if d != right]))
    if what == "phone":
        keep = 1 if len(norm) > 10 else 0
        return norm[:keep] + "".join(s.pick("0123456789") for _ in norm[keep:])
    if what == "iban":
        body = "".join(s.pick("0123456789") if c.isdigit() else s.pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c.isalpha() else c
                       for c in norm[4:])
        number = int("".join(str(int(c, 36)) for c in body + norm[:2] + "00"))
        return f"{norm[:2]}{98 - number % 97:02d}{body}"
    if what in ("given", "surname") and "-" in norm:
        return "-".join(propose(key, kind, f"{part}\0{k}", attempt) for k, part in enumerate(norm.split("-")))
    if what in ("given", "surname"):
        alphabet, gender = more
        if what == "given" and attempt < 8:
            return s.pick(GIVEN.get((alphabet, gender)) or GIVEN[alphabet, "m"]).lower()
        n = 2 + attempt // 24
        tail = ENDINGS.get((alphabet, gender), "") if what == "surname" else {"latin": "a", "cyrillic": "а", "greek": "α"}[alphabet] * (gender == "f")
        return "".join(s.pick(SYLLABLES[alphabet]) for _ in range(n)) + tail
    return s.like(norm)


def write(kind: str, norm: str, original: str) -> str:
    """A surrogate in the letter case and punctuation of the place it takes."""
    what = kind.split(":")[0]
    if what in ("card", "ssn", "phone", "iban"):
        it = iter(norm)
        return "".join(next(it) if c.isalnum() else c for c in original)
    if what in ("given", "surname"):
        return norm.upper() if original.isupper() and len(original) > 1 else "-".join(map(str.capitalize, norm.split("-")))
    if kind == "secret:mixed":
        return norm
    return norm.upper() if original.isupper() else norm


def same_names(found: DataFrame) -> DataFrame:
    """``kind, norm`` of the distinct entities, with ``as_kind, as_norm`` of the
    entity they are, and ``feminine``: whether a surname has the female ending.

    A surname is one entity under titles of any gender: by its script and, in
    Cyrillic and Greek, its male form. A given name under a title without gender
    is the one that a title with gender introduces, if any does.
    """
    each = found.select("kind", "norm").distinct()
    part = F.split("kind", ":")
    what, alphabet, gender = part[0], F.get(part, F.lit(1)), F.get(part, F.lit(2))
    cyrillic = F.regexp_replace(F.regexp_replace("norm", "(ов|ев|ёв|ин|ын)а$", "$1"), "(с|ц)кая$", "$1кий")
    plain = F.translate("norm", "άέήίόύώϊϋΐΰ", "αεηιουωιυιυ")
    greek = F.regexp_replace(F.regexp_replace(plain, "δου$", "δης"), "ου$", "ος")
    female = F.regexp_replace(F.regexp_replace(greek, "η$", "ης"), "α$", "ας")
    stem = (F.when((alphabet == "cyrillic") & (gender != "m"), cyrillic)
            .when((alphabet == "greek") & (gender != "m"), female).when(alphabet == "greek", greek).otherwise(F.col("norm")))
    shown = F.when(alphabet == "greek", plain).otherwise(F.col("norm"))
    known = (each.where((what == "given") & (gender != "n")).groupBy(F.col("norm").alias("_norm"))
             .agg(F.min("kind").alias("_kind")))
    each = each.join(known, (what == "given") & (gender == "n") & (F.col("norm") == F.col("_norm")), "left")
    surname = F.concat(F.lit("surname:"), alphabet, F.when(alphabet == "latin", ":n").otherwise(":m"))
    return each.select(
        "kind", "norm", F.when(what == "surname", surname).otherwise(F.coalesce("_kind", "kind")).alias("as_kind"),
        F.when(what == "surname", stem).otherwise(F.col("norm")).alias("as_norm"),
        ((what == "surname") & ((gender == "f") | ((gender == "n") & (stem != shown)))).alias("feminine"))


def coreferent(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, norm, surrogate``: one surrogate for all that is one entity, in the
    form that the gender of the place asks for."""
    entities = same_names(found).checkpoint()
    # Neither form of a surrogate may be a surname of the texts.
    surnames = entities.where(F.col("kind").startswith("surname:"))
    male = F.regexp_replace(F.regexp_replace("norm", "ова$", "ов"), "ίδου$", "ίδης")
    taken = surnames.select(F.lit("surname").alias("type"), F.explode(F.array("norm", male)).alias("surrogate"))
    made = surrogates(entities.select(F.col("as_kind").alias("kind"), F.col("as_norm").alias("norm")), key, taken=taken)
    made = made.select(F.col("kind").alias("as_kind"), F.col("norm").alias("as_norm"), "surrogate")
    form = F.when(F.col("feminine"), F.regexp_replace(F.regexp_replace("surrogate", "ов$", "ова"), "ίδης$", "ίδου"))
    return entities.join(made, ["as_kind", "as_norm"]).select("kind", "norm", F.coalesce(form, "surrogate").alias("surrogate"))


def surrogates(found: DataFrame, key: bytes, rounds: int = 400, taken: DataFrame | None = None) -> DataFrame:
    """``kind, norm, surrogate`` for the distinct entities of ``found``.

    Each round proposes for the open entities; of those that propose one value
    the smallest gets it, unless it is taken or an entity itself. The kinds of
    a type share one space of values; those of ``taken`` (``type, surrogate``)
    are not given. Raises if ``rounds`` leave any open.
    """
    entities = found.select("kind", "norm").distinct().withColumn("type", F.split("kind", ":")[0])
    entities = cut(entities, "entities")
    closed = entities.select("type", F.col("norm").alias("surrogate"))
    closed = (closed if taken is None else closed.unionByName(taken)).distinct()
    done, left, attempt = None, entities, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [propose(key, k, n, at) for k, n, at in zip(*(b.column(i).to_pylist() for i in (0, 1, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(values, pa.string())],
                                             ["kind", "norm", "type", "surrogate"])

    while attempt < rounds:
        # Later rounds propose more at once: few are open then, and a round is a job.
        many = 1 if attempt == 0 else 8
        tried = (left.select("kind", "norm", "type", F.explode(F.sequence(F.lit(attempt), F.lit(attempt + many - 1))).alias("at"))
                 .mapInArrow(run, "kind string, norm string, type string, surrogate string"))
        tried = tried.join(closed, ["type", "surrogate"], "left_anti")
        if done is not None:
            tried = tried.join(done.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        won = (tried.groupBy("type", "surrogate").agg(F.min(F.struct("norm", "kind")).alias("w"))
               .groupBy("type", "w.norm", "w.kind").agg(F.min("surrogate").alias("surrogate")))
        won = cut(won.select("kind", "norm", "type", "surrogate"), "surrogates")
        done = won if done is None else done.unionByName(won)
        left = left.join(won.select("kind", "norm"), ["kind", "norm"], "left_anti").checkpoint()
        if left.isEmpty():
            return done.select("kind", "norm", "surrogate")
        attempt += many
    raise RuntimeError(f"{left.count()} entities without a distinct surrogate after {attempt} attempts")


def replace(docs: DataFrame, key: bytes, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every entity in ``text`` replaced, and ``n_entities``.

    Texts without an entity are as they were, byte for byte; null stays null.
    Texts that hold nothing an entity could begin with are told in the JVM and
    never scanned; the others are scanned once and written with what was found. Entities are the same whatever row they stand in, ties and repeated rows
    included. Extra columns stay; ``n_entities`` and names that start with
    ``pii_`` are replaced. Empty tables give no rows. Only rows with an entity
    are shuffled; the others pass through the scan.
    """
    keep = [f for f in docs.schema.fields if f.name != "n_entities" and not f.name.startswith("pii_")]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in keep])
    names, at = docs.columns, docs.columns.index(text)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in keep])
    spans = T._parse_datatype_string("array<struct<a:int,b:int,kind:string,norm:string>>")
    perhaps = may_hold(F.col(f"`{text}`"))
    spans_pa = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("kind", pa.string()), ("norm", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            got = [find(t) if t else [] for t in b.column(at).to_pylist()]
            ids = pa.array([(part << 33) + n + k for k in range(len(got))], pa.int64())
            n += len(got)
            found = pa.array([[dict(zip(("a", "b", "kind", "norm"), e, strict=True)) for e in x] for x in got], spans_pa)
            yield pa.RecordBatch.from_arrays([*b.columns, ids, found], [*names, "pii_row", "pii_found"])

    held = T.StructType([*schema.fields, T.StructField("pii_row", T.LongType()), T.StructField("pii_found", spans)])
    scanned = cut(docs.where(perhaps).mapInArrow(scan, held), "found")
    hit = scanned.where(F.size("pii_found") > 0)
    each = hit.select("pii_row", F.posexplode("pii_found").alias("pii_at", "pii_e"))
    each = each.select("pii_row", "pii_at", "pii_e.kind", "pii_e.norm")
    given = (each.join(coreferent(each, key), ["kind", "norm"]).groupBy("pii_row")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("pii_at", "surrogate"))), lambda x: x["surrogate"])
                  .alias("pii_new")))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, found, new in zip(b.column(at).to_pylist(), b.column("pii_found").to_pylist(),
                                     b.column("pii_new").to_pylist(), strict=True):
                parts, last = [], 0
                for e, s in zip(found, new, strict=True):
                    parts += [t[last:e["a"]], write(e["kind"], s, t[e["a"]:e["b"]])]
                    last = e["b"]
                texts.append("".join([*parts, t[last:]]))
            columns = [pa.array(texts, b.schema.field(at).type) if k == at else b.column(k) for k in range(len(names))]
            sizes = pa.array([len(x) for x in b.column("pii_new").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, sizes], [*names, "n_entities"])

    changed = hit.join(given, "pii_row").select(*[f"`{n}`" for n in names], "pii_found", "pii_new").mapInArrow(
        put, T.StructType([*schema.fields, T.StructField("n_entities", T.IntegerType())]))
    clean = scanned.where(F.size("pii_found") == 0).select(*[f"`{n}`" for n in names]).unionByName(docs.where(~perhaps))
    return changed.unionByName(clean.withColumn("n_entities", F.lit(0)))
