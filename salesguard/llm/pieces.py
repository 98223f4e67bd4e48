"""SentencePiece encoding and decoding for merge-type vocabularies.

A text's symbols are its characters, blanks shown as U+2581 and one put in
front. An agenda holds every pair of adjacent symbols that together are a piece,
by score and then from the left; the first pair is merged, its new neighbours
go on the agenda, until it is empty. A symbol that is no piece is written as
its UTF-8 bytes, where the vocabulary has them. Where no piece has a blank after
another character, or a line feed, a text falls into units (blanks and the
characters up to the next blank or line feed) that no merge crosses. The distinct
units of a group of texts are merged side by side: in each round every unit's
first pair of its agenda, in numpy. Long units have a heap of their own.

With every Arrow batch, the units that were merged for it are also encoded by the
``sentencepiece`` library, and a difference raises; ``check="texts"`` has the library
encode and decode the whole texts of the batch instead, ``check=None`` nothing.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesguard.llm import units

BLANK = "▁"
#: Longer units are merged by a heap.
LONGEST = 64
#: No merge; symbols that are no pieces are numbered by their character from the pieces' number on.
NEVER, SHIFT = 1 << 30, 21
#: A batch handed on has texts of about so many characters, or one text.
BATCH_IDS = 1 << 21
#: Kinds of pieces in the file's format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_UNITS = re.compile(r" +[^ \n]*|\n[^ \n]*|[^ \n]+")
_LOST = b"\xef\xbf\xbd"


class Vocabulary:
    """The pieces, scores and settings of a model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        kinds = {p.type for p in spec.pieces}
        if (spec.trainer_spec.model_type != spec.trainer_spec.BPE or kinds & {USER_DEFINED, UNUSED}
                or spec.normalizer_spec.precompiled_charsmap or spec.normalizer_spec.remove_extra_whitespaces
                or not spec.normalizer_spec.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("only merge-type vocabularies without normalization, user-defined or unused pieces")
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        self.pieces = {p.piece: k for k, p in enumerate(spec.pieces) if p.type == NORMAL}
        places = {x: k for k, x in enumerate(sorted({-p.score for p in spec.pieces if p.type == NORMAL}))}
        self.ranks = {p.piece: places[-p.score] for p in spec.pieces if p.type == NORMAL}
        self.bytes = [0] * 256
        self.unknown = next(k for k, p in enumerate(spec.pieces) if p.type == UNKNOWN)
        self.surface: list[bytes] = []
        self.raw = np.zeros(len(spec.pieces), bool)
        for k, p in enumerate(spec.pieces):
            if p.type == BYTE:
                value = int(p.piece[1:-1], 16)
                self.bytes[value], self.raw[k] = k, True
                self.surface.append(bytes([value]))
            elif p.type == UNKNOWN:
                self.surface.append(spec.trainer_spec.unk_surface.encode())
            else:
                self.surface.append(b"" if p.type == CONTROL else p.piece.replace(BLANK, " ").encode())
        self.fallback = bool(self.raw.any())
        self.whole = any("\n" in p or BLANK in p.lstrip(BLANK) for p in self.pieces)
        self.surfaces = pa.array(self.surface, pa.binary())
        self.control = np.array([not x for x in self.surface])
        self.blank = np.array([p.type == NORMAL and p.piece[:1] == BLANK for p in spec.pieces])
        self.size = len(self.surface)
        self.symbols = np.arange(0x110000, dtype=np.int32) + self.size
        for p, k in self.pieces.items():
            if len(p) == 1:
                self.symbols[ord(p)] = k
        if self.fallback:                                 # one byte each, as the pieces they are written as
            for c in range(128):
                if self.symbols[c] >= self.size:
                    self.symbols[c] = self.bytes[c]
        self.symbols[ord(" ")] = self.symbols[ord(BLANK)]
        pairs = {}
        for p, k in self.pieces.items():
            for i in range(1, len(p)):
                a, b = self._symbol(p[:i]), self._symbol(p[i:])
                if a is not None and b is not None:
                    pairs[a << SHIFT | b] = k
        self.pairs = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[x] for x in self.pairs.tolist()], np.int32)
        self.order = np.full(self.size, NEVER, np.int32)
        for p, k in self.pieces.items():
            self.order[k] = self.ranks[p]

    def _symbol(self, text: str) -> int | None:
        return int(self.symbols[ord(text)]) if len(text) == 1 else self.pieces.get(text)

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the score order, and merged piece, of pairs of symbols."""
        key = a.astype(np.int64) << SHIFT | b
        at = np.searchsorted(self.pairs, key)
        at[at == len(self.pairs)] = 0
        hit = self.pairs[at] == key
        piece = self.merged[at]
        return np.where(hit, self.order[piece], NEVER), piece

    def merge_units(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of many units after all merges, and how many each has. Every
        round takes, in all units that still have one, the first pair of the best
        score, and looks up the pairs that the new symbol forms."""
        size = np.array([len(u) for u in words], np.int64)
        sym = self.symbols[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        left = np.arange(len(words))
        counts = size.copy()
        rank, piece = np.full(len(sym), NEVER, np.int32), np.zeros(len(sym), np.int32)
        rank[:-1], piece[:-1] = self._look(sym[:-1], sym[1:])
        rank[np.cumsum(size) - 1] = NEVER                  # a pair does not reach into the next unit
        done_sym, done_unit = [], []
        while len(left):
            start = np.cumsum(size) - size
            best = np.minimum.reduceat(rank, start)
            over = best == NEVER
            if over.any():
                rest = np.repeat(~over, size)
                done_unit.append(np.repeat(left[over], size[over]))
                done_sym.append(sym[~rest])
                counts[left[over]] = size[over]
                sym, rank, piece = sym[rest], rank[rest], piece[rest]
                left, size, best = left[~over], size[~over], best[~over]
                if not len(left):
                    break
            unit = np.repeat(np.arange(len(left)), size)
            found = np.flatnonzero(rank == best[unit])
            at = found[np.diff(unit[found], prepend=-1) > 0]
            sym[at] = piece[at]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            rank[at] = rank[at + 1]                        # to be looked up below, unless it ends the unit
            sym, rank, piece, unit = sym[stay], rank[stay], piece[stay], unit[stay]
            size = size - 1
            at = at - np.arange(len(at))
            ends = np.cumsum(size) - 1
            begins = ends - size + 1
            right, before = at[at < ends], at[at > begins] - 1
            rank[ends] = NEVER
            for x in (right, before):
                rank[x], piece[x] = self._look(sym[x], sym[x + 1])
        unit, sym = np.concatenate(done_unit or [left]), np.concatenate(done_sym or [sym])
        return sym[np.argsort(unit, kind="stable")], counts

    def merge(self, symbols: list[str]) -> list[str]:
        """The symbols of one unit after all merges."""
        n, ranks = len(symbols), self.ranks
        agenda = []
        for i in range(n - 1):
            both = symbols[i] + symbols[i + 1]
            if both in ranks:
                agenda.append((ranks[both], i, i + 1, len(both)))
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        symbols = symbols[:]
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != size:
                continue                                  # one of the two went into another merge
            symbols[i] += symbols[j]
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                both = symbols[i] + symbols[k]
                if both in ranks:
                    heapq.heappush(agenda, (ranks[both], i, k, len(both)))
            h = before[i]
            if h >= 0:
                both = symbols[h] + symbols[i]
                if both in ranks:
                    heapq.heappush(agenda, (ranks[both], h, i, len(both)))
        return [s for s in symbols if s]

    def ids(self, unit: str) -> list[int]:
        """Ids of a unit, blanks as blanks."""
        symbols = self.merge(list(unit.replace(" ", BLANK)))
        found = list(map(self.pieces.get, symbols))
        if None not in found:
            return found
        out = []
        for s, k in zip(symbols, found, strict=True):
            if k is not None:
                out.append(k)
            elif self.fallback:
                out += [self.bytes[b] for b in s.encode()]
            elif not out or out[-1] != self.unknown:      # neighbours that are unknown are one
                out.append(self.unknown)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the blank put in front; bytes that are no
        UTF-8 become U+FFFD each, as the library has it."""
        parts = list(map(self.surface.__getitem__, ids.tolist()))
        first = next((k for k, x in enumerate(parts) if x), None)
        if self.prefix and first is not None and ids[first] != self.unknown and not self.raw[ids[first]]:
            parts[first] = parts[first].removeprefix(b" ")
        if not self.raw[ids].any():
            return b"".join(parts).decode()
        out, at = [], np.flatnonzero(np.diff(np.r_[False, self.raw[ids], False].astype(np.int8)))
        last = 0
        for a, z in zip(at[::2].tolist(), at[1::2].tolist(), strict=True):
            out += [*parts[last:a], _valid(b"".join(parts[a:z]))]
            last = z
        return b"".join(out + parts[last:]).decode()


    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of many lists of ids, which end at ``ends`` (the first is 0)."""
        taken = self.surfaces.take(pa.array(ids))
        data = taken.buffers()[2]
        data = memoryview(data) if data else b""
        at = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset:taken.offset + len(ids) + 1][ends].tolist()
        bytes_in, controls = (np.diff(np.r_[0, np.cumsum(x[ids])][ends]) > 0 for x in (self.raw, self.control))
        first = ids[np.minimum(ends[:-1], max(len(ids) - 1, 0))] if len(ids) else np.zeros(len(ends) - 1, int)
        cut = self.blank[first] & self.prefix
        out = []
        for k, (a, z) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if ends[k] == ends[k + 1]:
                out.append(b"")
                continue
            raw = bytes(data[a + int(cut[k]):z])
            if bytes_in[k] or controls[k]:
                try:
                    if controls[k]:
                        raise UnicodeError
                    raw.decode()
                except UnicodeError:
                    raw = self.decode(ids[ends[k]:ends[k + 1]]).encode()
            out.append(raw)
        return pa.array(out, pa.binary()).cast(pa.string())


def _valid(raw: bytes) -> bytes:
    """Bytes outside whole characters become U+FFFD, each for itself."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                raw[at:at + n].decode()
            except UnicodeDecodeError:
                continue
            out.append(raw[at:at + n])
            at += n
            break
        else:
            out.append(_LOST)
            at += 1
    return b"".join(out)


class Encoder:
    """Ids of whole texts, and the units that were merged for them.

    A key is a unit less its first blank, or a unit that begins with a line feed."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.whole = vocabulary.whole or not vocabulary.fallback or not vocabulary.prefix
        self.kind = np.uint16 if vocabulary.size <= 1 << 16 else np.uint32

    def units(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units in a row, and where each begins (and the last ends)."""
        v = self.vocabulary
        texts = [k if k[:1] == "\n" else " " + k for k in keys]
        short = [k for k, u in enumerate(texts) if len(u) <= LONGEST]
        sym, counts = v.merge_units([texts[k] for k in short])
        ends = np.cumsum(counts)
        strange = set(np.searchsorted(ends, np.flatnonzero(sym >= v.size), side="right").tolist())
        if len(short) == len(texts) and not strange:
            return sym, np.r_[0, ends]
        plain = dict(zip(short, zip(ends - counts, ends, strict=True), strict=True))
        odd = {short[k] for k in strange} | set(range(len(texts))).difference(short)
        parts = [np.array(v.ids(texts[k]), np.int32) if k in odd else sym[slice(*plain[k])] for k in range(len(texts))]
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def encode(self, texts: list[str], library=None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each begins (and the last ends).
        With ``library``, the units' ids are compared with its own."""
        v = self.vocabulary
        texts = [t.replace(BLANK, " ") for t in texts]
        if self.whole:
            parts = [v.ids(" " * v.prefix + t) if t else [] for t in texts]
            return np.array([x for p in parts for x in p], np.int32), np.cumsum([0, *map(len, parts)])
        found = [self._group(texts[a:z], library) for a, z in units.groups(texts)]
        ids = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int32)
        return ids, np.r_[0, np.cumsum(np.concatenate([n for _, n in found]))] if found else np.zeros(1, np.int64)

    def _group(self, texts: list[str], library) -> tuple[np.ndarray, np.ndarray]:
        easy = [k for k, t in enumerate(texts) if t and t[0] != " " and "  " not in t]
        hard = [k for k, t in enumerate(texts) if t and (t[0] == " " or "  " in t)]
        keys, of, ends = units.split([texts[k] for k in easy])
        cut = [[u[1:] if u[0] == " " else u for u in _UNITS.findall(" " + texts[k])] for k in hard]
        more, of_more = units.distinct(pa.array([u for c in cut for u in c], pa.string()))
        of = np.r_[of, of_more + len(keys)]
        ends = np.r_[ends, (ends[-1] if len(ends) else 0) + np.cumsum([len(c) for c in cut], dtype=np.int64)].astype(np.int64)
        keys += more
        if not keys:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        ids, at = self.units(keys)
        if library is not None:
            _same_units(library, keys, ids, at)
        every, stops = units.gather(ids, at[:-1], np.diff(at), of, ends)
        size = np.zeros(len(texts), np.int64)
        size[easy + hard] = np.diff(stops, prepend=0)
        if hard:                                           # back into the order of the texts
            begin = np.zeros(len(texts), np.int64)
            begin[easy + hard] = np.r_[0, stops[:-1]]
            every, _ = units.gather(every, begin, size, np.arange(len(texts)), np.arange(1, len(texts) + 1))
        return every.astype(np.int32), size


def _same_units(library, keys: list[str], ids: np.ndarray, at: np.ndarray) -> None:
    """The library puts a blank in front of each unit that has none."""
    want = library.encode(keys, num_threads=1)
    size = np.fromiter(map(len, want), np.int64, len(want))
    every = np.fromiter(chain.from_iterable(want), np.int64, int(size.sum()))
    lone = np.array([not k for k in keys])                # the blank alone: an empty text has no ids there
    feeds = np.array([k[:1] == "\n" for k in keys])
    first = np.cumsum(size) - size
    blank = library.piece_to_id(BLANK)
    if not (every[first[feeds]] == blank).all():
        raise AssertionError("the library has no blank before a line feed")
    own, begin = np.diff(at), first + feeds
    wrong = np.flatnonzero((size - feeds != own) & ~lone)
    if not len(wrong):
        some = np.flatnonzero(~lone)
        theirs, _ = units.gather(every, begin, own, some, np.array([len(some)]))
        mine, _ = units.gather(ids, at[:-1], own, some, np.array([len(some)]))
        wrong = np.repeat(some, own[some])[theirs != mine]
    if len(wrong):
        raise AssertionError(f"ids differ from the library's for {keys[wrong[0]][:200]!r}")


def _same_texts(library, texts: list[str], ids: np.ndarray, ends: np.ndarray, decoded: list[str] | None) -> None:
    want = library.encode(texts, num_threads=1)
    for k, (text, theirs) in enumerate(zip(texts, want, strict=True)):
        if ids[ends[k]:ends[k + 1]].tolist() != theirs:
            raise AssertionError(f"ids differ from the library's for {text[:200]!r}")
    if decoded is not None and library.decode(want, num_threads=1) != decoded:
        raise AssertionError("a decoded text differs from the library's")


def encode(docs: DataFrame, path: str, text: str = "text", columns: list[str] | None = None, decoded: bool = False,
           check: str | None = "units") -> DataFrame:
    """Adds ``ids`` (array of int) to every row (of ``columns``, by default all)
    and, if asked, ``decoded``, the text that the ids decode to.

    Whole texts are encoded, without begin and end ids. Null and empty texts
    have no ids and decode to the empty text. Repeated rows are encoded each, an
    empty table gives no rows. Extra columns stay; those with the added names are
    replaced. A text of any length is encoded whole by one task. A scan without
    a shuffle; a batch of long texts is handed on in parts.
    """
    added = ["ids", *(["decoded"] if decoded else [])]
    keep = [f for f in docs.schema.fields if f.name not in added and (columns is None or f.name in columns)]
    names = [f.name for f in keep]
    rows = docs.select(*[F.col(f"`{n}`") for n in names], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text\0"))
    at = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        vocabulary = Vocabulary(path)
        own = Encoder(vocabulary)
        library = sentencepiece.SentencePieceProcessor(model_file=path) if check else None
        by_text = check == "texts" or own.whole

        def part(b: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
            ids, ends = own.encode(texts, None if by_text else library)
            back = vocabulary.decode_all(ids, ends) if decoded else None
            if library and by_text:
                _same_texts(library, texts, ids, ends, back.to_pylist() if decoded else None)
            out = [*b.columns[:at], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))]
            return pa.RecordBatch.from_arrays(out + ([back] if decoded else []), names + added)

        for b in batches:
            texts = b.column(at).to_pylist()
            first = size = 0
            for k, t in enumerate(texts):                  # a text has about as many bytes as ids at most
                size += len(t)
                if size >= BATCH_IDS or k + 1 == len(texts):
                    yield part(b.slice(first, k + 1 - first), texts[first:k + 1])
                    first, size = k + 1, 0
            if not texts:
                yield part(b, [])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)
    return rows.mapInArrow(run, schema + "ids array<int>" + (", decoded string" if decoded else ""))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text of each row's array of ids; null and empty arrays
    give the empty text, null ids are left out, an id outside the vocabulary is
    an error. Other columns stay; one with the added name is replaced."""
    keep = [f for f in rows.schema.fields if f.name != out]
    names = [f.name for f in keep]
    take = rows.select(*[F.col(f"`{n}`") for n in names],
                       F.filter(F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")), lambda x: x.isNotNull()).alias("ids\0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for b in batches:
            lists = b.column(len(names))
            x = lists.flatten().to_numpy(zero_copy_only=False)
            if len(x) and not 0 <= x.min() <= x.max() < vocabulary.size:
                raise ValueError("an id outside the vocabulary")
            ends = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], vocabulary.decode_all(x, ends)], [*names, out])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in keep)
    return take.mapInArrow(run, f"{schema}`{out}` string")
