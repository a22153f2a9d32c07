"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse as a byte-to-text state machine.

Merges happen in the order of the list.  Let the bytes up to some place be known and all that follows unknown.  A rule
(u, v) can carry the unknown further left only where u is the last known token and the unknown begins with v; then u
becomes unknown too.  After a rule with left side u the unknown begins with u or with what u grew into, so the next rule
that carries on is a later one whose right side begins, along the left sides of its merges, with u.  ``Merges`` follows
these chains through the list once; the heaviest chain, in bytes of left sides, is the lookahead: tokens that end so many
bytes before the end of what is known never change, whatever follows, and are emitted.  What is held is bounded by the
lookahead and one window, for a word of any length.

Texts are cut into words as the byte-level pre-tokenizer cuts them (special tokens first).  Short words repeat, so each
distinct one goes through the transducer once per Python worker; long words and long texts are streamed.  Words are
known by 64-bit hashes.  Decoding looks up each id's bytes and feeds them to an incremental UTF-8 decoder, which holds at
most three bytes of an unfinished character; bytes that are no UTF-8 become U+FFFD.

Only for ``tokenizers`` files of this kind: byte-level BPE, no normalizer, no post-processor tokens asked for, every merge
making a token of its own from parts made earlier.  Others raise ``ValueError``.

Defined results: a null or empty text has no ids, a null or empty list of ids is an empty text; null ids and ids without
a token add nothing; repeated rows are encoded each by itself; an empty table gives no rows; other columns are passed on
untouched, and a column already named like the result is replaced.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from verdant.llm.arrays import range_hash, steps, utf8
from verdant.llm.token_ids import WordEncoder, _byte_letters

#: Words up to this many bytes are kept in a worker's memory, of at most so many words; neither changes a result.
SHORT, MEMORY_WORDS = 64, 1_000_000
#: Bytes of a text, and of a word, that are worked on together.
CHUNK, WINDOW = 1 << 20, 1 << 14

SPACE, LETTER, NUMBER, OTHER, SPECIAL = range(5)
_APOSTROPHE = ord("'")

_loaded: dict[str, Merges] = {}
_encoders: dict[str, Encoder] = {}


class Merges:
    """The merge list of a ``tokenizers`` file and the lookahead that it needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True)
                or spec["normalizer"] or model.get("ignore_merges") or model.get("dropout")):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        letters = _byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        vocabulary = model["vocab"]
        if any(c not in vocabulary for c in letters.values()):
            raise ValueError(f"{path}: not every byte is a token")
        self.byte_ids = [vocabulary[letters[b]] for b in range(256)]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        left_of, size, made = {}, dict.fromkeys(self.byte_ids, 1), set(self.byte_ids)
        reach: dict[int, int] = {}  # heaviest chain that ends with a rule of this left side
        self.lookahead = 0
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            u, v, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if u not in made or v not in made or whole in made:
                raise ValueError(f"{path}: merge {rank} has a part not yet made or makes a token again")
            made.add(whole)
            self.pairs[u, v] = (rank, whole)
            left_of[whole], size[whole] = u, size[u] + size[v]
            before, begins = reach.get(v, 0), v
            while begins in left_of:
                begins = left_of[begins]
                before = max(before, reach.get(begins, 0))
            reach[u] = max(reach.get(u, 0), before + size[u])
            self.lookahead = max(self.lookahead, reach[u])
        self.special = [(t["content"].encode(), t["id"]) for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: special tokens that strip or stand alone")
        count = 1 + max([*vocabulary.values(), *(i for _, i in self.special)])
        spelled = [b""] * count
        for token, i in vocabulary.items():
            spelled[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for content, i in self.special:
            spelled[i] = content
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.size = np.array([len(s) for s in spelled], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def merge(self, data: bytes) -> list[int]:
        """Tokens of bytes that are known whole: the pair earliest in the list first, of equal ones the leftmost."""
        ids = [self.byte_ids[b] for b in data]
        n, pairs = len(ids), self.pairs
        if n < 2:
            return ids
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(*found, i) for i in range(n - 1) if (found := pairs.get((ids[i], ids[i + 1])))]
        heapify(queue)
        while queue:
            _, whole, i = heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get((ids[i], ids[j]), (0, -1))[1] != whole:
                continue  # one of the pair has been merged since
            ids[i], ids[j], after[i] = whole, -1, after[j]
            if after[i] < n:
                ahead[after[i]] = i
                if found := pairs.get((whole, ids[after[i]])):
                    heappush(queue, (*found, i))
            if (h := ahead[i]) >= 0 and (found := pairs.get((ids[h], whole))):
                heappush(queue, (*found, h))
        return [i for i in ids if i >= 0]

    def spell(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, one after the other; ids without a token have none."""
        ids = ids[(ids >= 0) & (ids < len(self.size))]
        size = self.size[ids]
        reach = np.cumsum(size)
        total = int(reach[-1]) if len(reach) else 0
        return self.spelled[np.repeat(self.start[ids] - reach + size, size) + np.arange(total)].tobytes()


def merges(path: str) -> Merges:
    """The worker's merge list for a file."""
    if path not in _loaded:
        _loaded[path] = Merges(path)
    return _loaded[path]


class WordTransducer:
    """One word, fed in parts: a token is emitted once nothing that may follow can change it."""

    def __init__(self, rules: Merges):
        self.rules, self.held = rules, bytearray()

    def feed(self, data: bytes) -> list[int]:
        self.held += data
        out, at, ahead = [], 0, self.rules.lookahead
        while len(self.held) - at >= WINDOW + ahead:
            tokens = self.rules.merge(bytes(self.held[at : at + WINDOW + ahead]))
            ends = np.cumsum(self.rules.size[tokens])
            stable = int(np.searchsorted(ends, WINDOW, "right"))
            out += tokens[:stable]
            at += int(ends[stable - 1])
        del self.held[:at]
        return out

    def finish(self) -> list[int]:
        out, self.held = self.rules.merge(bytes(self.held)), bytearray()
        return out


class Encoder(WordEncoder):
    """Texts to ids; a hash table remembers the ids of short words."""

    def __init__(self, path: str):
        self.rules = merges(path)
        self.cutter = ByteLevel(add_prefix_space=False)
        self.kind = {}  # of characters beyond ASCII, as they occur
        self.ascii = np.array([self._kind_of(chr(c)) for c in range(128)], np.int8)
        self.margin = max([len(s) for s, _ in self.rules.special], default=0) + 16
        self.forget()

    def _kind_of(self, character: str) -> int:
        """Which class of the pre-tokenizer's pattern takes a character: it is asked, as its Unicode version counts."""
        for kind, mate in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.cutter.pre_tokenize_str(mate + character)) == 1:
                return kind
        return SPACE

    def _kinds(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The class of every character."""
        kinds = self.ascii[data[begins] & 127]
        wide = np.flatnonzero(data[begins] >= 128)
        if len(wide):
            at = begins[wide]
            bytes4 = np.zeros((len(at), 4), np.uint8)
            size = np.diff(np.append(begins, len(data)))[wide]
            for k in range(4):
                has = size > k
                bytes4[has, k] = data[at[has] + k]
            codes, which = np.unique(bytes4.view(np.uint32).ravel(), return_inverse=True)
            for code in codes.tolist():
                if code not in self.kind:
                    self.kind[code] = self._kind_of(code.to_bytes(4, "little").rstrip(b"\0").decode("utf-8", "replace")[:1])
            kinds[wide] = np.array([self.kind[c] for c in codes.tolist()], np.int8)[which]
        return kinds

    def words(self, data: np.ndarray, offsets: np.ndarray, inside: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(start of each word, id of the special token it is or -1) of a batch of texts.

        inside: the first text goes on in a word begun before.
        """
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        kinds, n = self._kinds(data, begins), len(begins)
        edge = np.zeros(n + 1, bool)
        edge[np.searchsorted(begins, offsets)] = True
        raw, special, taken = data.tobytes(), {}, 0
        found = sorted((at, -len(s), i) for s, i in self.rules.special for at in _places(raw, s))
        for at, size, i in found:
            inner = np.searchsorted(offsets, at, "right")
            if at >= taken and offsets[inner] >= at - size:  # of overlapping ones the first, then the longest; within one text
                a, b = np.searchsorted(begins, (at, at - size))
                kinds[a:b], edge[a], edge[b], special[int(a)], taken = SPECIAL, True, True, i, at - size
        runs = edge[:-1].copy()
        runs[1:] |= kinds[1:] != kinds[:-1]
        start = runs.copy()
        first = np.flatnonzero(runs)
        last = np.append(first[1:], n)
        spaces = (kinds[first] == SPACE) & ~edge[last]
        lone = last[spaces] - 1  # the last white space before something: alone, or with what follows if it is a blank
        start[lone] = True
        start[lone[data[begins[lone]] == 32] + 1] = False
        marks = np.flatnonzero(start & runs & (data[begins] == _APOSTROPHE))
        marks = marks[(marks + 1 < n) & ~edge[np.minimum(marks + 1, n)]]
        if inside:
            marks = marks[marks > 0]
        if len(marks):
            one, two = data[begins[marks + 1]], data[begins[np.minimum(marks + 2, n - 1)]]
            two = np.where((marks + 2 < n) & ~edge[np.minimum(marks + 2, n)], two, 0)
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            start[marks[short | long] + 1] = False
            end = np.append(marks[short] + 2, marks[long] + 3)
            start[end[end < n]] = True
        chars = np.flatnonzero(start)
        ids = np.full(len(chars), -1, np.int64)
        if special:
            ids[np.searchsorted(chars, list(special))] = list(special.values())
        return begins[chars], ids

    def _remember(self, hashes: np.ndarray, words: list[bytes]) -> None:
        new = [self.rules.merge(w) for w in words]
        sizes = np.array([len(x) for x in new], np.int64)
        ids = np.array([i for x in new for i in x], np.int32)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        while self.count + len(new) > len(self.start):
            self.start, self.size = np.append(self.start, self.start * 0), np.append(self.size, self.size * 0)
        to = slice(self.count, self.count + len(new))
        self.flat[self.used : self.used + len(ids)] = ids
        self.size[to] = sizes
        self.start[to] = self.used + np.cumsum(sizes) - sizes
        self._enter(hashes, np.arange(to.start, to.stop, dtype=np.int32))
        self.used += len(ids)
        self.count = to.stop

    def forget(self) -> None:
        super().forget()
        self.flat = np.zeros(1 << 14, np.int32)

    def _ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word)."""
        if self.count > MEMORY_WORDS:
            self.forget()
        plain = np.flatnonzero((special < 0) & (ends - starts <= SHORT))
        hashes = range_hash(data, starts[plain], ends[plain]) | np.uint64(1)
        at = self._find(hashes)
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            fresh = fresh[np.unique(hashes[fresh], return_index=True)[1]]
            self._remember(hashes[fresh], [data[a:b].tobytes() for a, b in zip(starts[plain[fresh]].tolist(), ends[plain[fresh]].tolist())])
            at = self._find(hashes)
        size, where = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        size[plain], where[plain] = self.size[at], self.start[at]
        source, extra = self.flat[: self.used], []
        base = self.used
        for k in np.flatnonzero((special >= 0) | (ends - starts > SHORT)).tolist():
            if special[k] >= 0:
                new = [int(special[k])]
            else:
                word = WordTransducer(self.rules)
                new = [i for a in range(starts[k], ends[k], WINDOW) for i in word.feed(data[a : min(a + WINDOW, ends[k])].tobytes())] + word.finish()
            size[k], where[k] = len(new), base
            base += len(new)
            extra.append(np.array(new, np.int32))
        if extra:
            source = np.concatenate([source, *extra])
        reach = np.cumsum(size)
        total = int(reach[-1]) if len(reach) else 0
        return source[np.repeat(where - reach + size, size) + np.arange(total)], size

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of a batch of whole texts, offsets of each text's ids)."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        starts, special = self.words(data, offsets)
        ids, size = self._ids(data, starts, np.append(starts[1:], len(data)), special)
        return ids, np.append(0, np.cumsum(size))[np.searchsorted(starts, offsets)]


def _places(raw: bytes, part: bytes) -> Iterator[int]:
    at = raw.find(part)
    while at >= 0:
        yield at
        at = raw.find(part, at + 1)


class TextTransducer:
    """One text, fed in parts of any size: ids come out as soon as they are settled."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.held, self.open = encoder, b"", None  # open: a word longer than a part

    def feed(self, data: bytes) -> np.ndarray:
        return self._take(data, False)

    def finish(self) -> np.ndarray:
        return self._take(b"", True)

    def _take(self, more: bytes, end: bool) -> np.ndarray:
        encoder, raw = self.encoder, self.held + more
        margin = 0 if end else encoder.margin
        if len(raw) <= margin and not (end and (raw or self.open)):
            self.held = raw
            return np.zeros(0, np.int32)
        known = len(raw) if end else _whole_characters(raw)
        data = np.frombuffer(raw, np.uint8)[:known]
        starts, special = encoder.words(data, np.array([0, known]), inside=self.open is not None) if known else (np.zeros(0, np.int64),) * 2
        ends = np.append(starts[1:], known)
        out, first = [], 0
        if self.open:
            rest = len(starts) and special[0] < 0 and self._goes_on(data, starts)
            if rest and not end and ends[0] > known - margin:  # still inside
                return self._stay_inside(raw, known, margin, out)
            if rest:
                out.append(np.array(self.open.feed(data[: ends[0]].tobytes()), np.int32))
                first = 1
            out.append(np.array(self.open.finish(), np.int32))
            self.open = None
        settled = len(starts) if end else int(np.searchsorted(ends, known - margin, "right"))
        if settled > first:
            to = int(ends[settled - 1])
            out.append(encoder._ids(data[:to], starts[first:settled], ends[first:settled], special[first:settled])[0])
            self.held = raw[to:]
        else:
            to = int(starts[first]) if first < len(starts) else known
            self.held = raw[to:]
            if not end and known - to > margin + WINDOW:
                self.open, self.kind = WordTransducer(encoder.rules), self._kind(data[to:])
                return np.concatenate([*out, self._stay_inside(raw[to:], known - to, margin, [])])
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def _stay_inside(self, raw: bytes, known: int, margin: int, out: list[np.ndarray]) -> np.ndarray:
        """Passes all but the margin on to the open word."""
        to = _whole_characters(raw[: known - margin])
        out.append(np.array(self.open.feed(raw[:to]), np.int32))
        self.held = raw[to:]
        return np.concatenate(out)

    def _kind(self, data: np.ndarray) -> int:
        begins = np.flatnonzero((data[:8] & 0xC0) != 0x80)[:2]
        kinds = self.encoder._kinds(data[: int(begins[1]) if len(begins) > 1 else len(data)], begins[:1])
        if kinds[0] == SPACE and data[0] == 32 and len(data) > 1 and (second := self._kind(data[1:])) != SPACE:
            return second  # the blank before a run
        return int(kinds[0])

    def _goes_on(self, data: np.ndarray, starts: np.ndarray) -> bool:
        """Whether the first word of what is held is the rest of the open one."""
        begins = np.flatnonzero((data[:5] & 0xC0) != 0x80)[:1]
        same = int(self.encoder._kinds(data[:4], begins)[0]) == self.kind
        if self.kind != SPACE or not same:
            return same
        return not (data[0] == 32 and len(data) > 1 and self._kind(data) != SPACE)


def _whole_characters(raw: bytes) -> int:
    """Bytes up to the end of the last whole character."""
    for back in range(1, min(4, len(raw)) + 1):
        lead = raw[-back]
        if lead & 0xC0 != 0x80:
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return len(raw) if back >= size else len(raw) - back
    return len(raw)


class Decoder:
    """Ids to text, fed in parts of any size: characters come out once all their bytes are there."""

    def __init__(self, rules: Merges):
        self.rules, self.machine = rules, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        return self.machine.decode(self.rules.spell(ids))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _with(docs: DataFrame, column: str, kind: T.DataType, run) -> DataFrame:
    others = [f for f in docs.schema if f.name != column]
    return docs.mapInArrow(run, T.StructType([*others, T.StructField(column, kind)]))


def _set(batch: pa.RecordBatch, column: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != column]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), values], [*names, column])


def encode(docs: DataFrame, path: str, *, text_col: str = "text", ids_col: str = "ids", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with the ids of every text, as the ``tokenizers`` library gives them without added special tokens.

    chunk: bytes of texts that are worked on together; a longer text is streamed in parts of this size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_encoder = encoder(path)
        for batch in steps(batches, text_col, chunk):
            data, offsets = utf8(batch.column(text_col))
            if len(data) > chunk and batch.num_rows == 1:
                text = TextTransducer(text_encoder)
                parts = [text.feed(data[a : a + chunk].tobytes()) for a in range(0, len(data), chunk)]
                ids = np.concatenate([*parts, text.finish()])
                cuts = np.array([0, len(ids)])
            else:
                ids, cuts = text_encoder.encode(data, offsets)
            yield _set(batch, ids_col, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32())))

    return _with(docs, ids_col, T.ArrayType(T.IntegerType()), run)


def decode(rows: DataFrame, path: str, *, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the text that every list of ids spells, special tokens included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = merges(path)
        for batch in batches:
            lists = batch.column(ids_col)
            texts = []
            for k in range(batch.num_rows):
                ids = lists[k].values
                if ids is None:
                    texts.append("")
                    continue
                ids, text = ids.cast(pa.int64()).drop_null().to_numpy(zero_copy_only=False), Decoder(rules)
                texts.append("".join(text.feed(ids[a : a + CHUNK]) for a in range(0, len(ids), CHUNK)) + text.finish())
            yield _set(batch, text_col, pa.array(texts, pa.string()))

    return _with(rows, text_col, T.StringType(), run)
