"""BPE encoding by a tokenization automaton, and decoding by its arc labels.

Compilation applies one merge gadget for each merge, in rank order, to the automaton that accepts every sequence
of base symbols. Where all arcs labelled u lead to state p and p has an arc v, the gadget for (u, v) -> w
  * makes a copy of p without v and redirects every u arc to the copy,
  * adds an arc w, to where v led, to each state that has an arc u.
After all gadgets the automaton is deterministic and accepts exactly the right tokenizations: one path for each
word. The target of an arc depends on its label alone, so a state is stored once for each label; a copy is stored
as its origin, the arc it lost and its birth (the merge's rank), and an arc that a gadget added is looked up
through the state's origin at that birth. That table has one row for each merge.

A word is read byte by byte. For each prefix the automaton has exactly one path, so a configuration (the arcs that may
be under way, each as a place in the labels' trie with the state that it left) has one successor for each byte, and at
most one arc ends there. Successors are entered in a bounded table of steps when a text first needs them; nearly
every byte is then one lookup. The arcs that ended are followed back from the word's end. Decoding emits their labels.

Texts are prepared as the vocabulary file demands: NFC, white space, lower case, its split pattern, bytes as
printable characters, a suffix on a word's last symbol; special tokens in the text are their own ids.

Defined results: null and empty texts have no tokens; repeated rows are each encoded; columns other than id and
text are ignored; decode of an empty list is the empty text.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tessella.llm.arrays import slices
from tessella.shipping import ship

#: Entries of a worker's tables: steps through configurations, and white-space separated pieces with their ids (twice as
#: many, in two generations). Together they stay under 90 MB; what is forgotten is computed again.
MAX_STEPS = 250_000
MAX_PIECES = 100_000
MAX_PIECE = 48
_END = (1 << 36) - 1

#: Unicode's White_Space; Python's own \\s has four separators more.
SPACE = "\t-\r \x85\xa0  -     　"
_ODD = regex.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Trie:
    """The labels over bytes (256 more for a byte with the suffix), as sorted arcs in flat arrays."""

    def __init__(self, words: list[tuple[bytes, int]]):
        """words: each label as 16-bit big-endian symbols, and its id."""
        words.sort()
        parents, symbols = array("q"), array("q")
        self.token_at, self.depth = array("i", [-1]), array("H", [0])
        path, last = [0], b""
        for word, w in words:
            n = len(word) // 2
            same = 0
            while same < min(n, len(last) // 2) and word[2 * same : 2 * same + 2] == last[2 * same : 2 * same + 2]:
                same += 1
            del path[same + 1 :]
            for k in range(same, n):
                parents.append(path[-1])
                symbols.append(word[2 * k] << 8 | word[2 * k + 1])
                path.append(len(self.token_at))
                self.token_at.append(-1)
                self.depth.append(k + 1)
            self.token_at[path[-1]] = w
            last = word
        keys = np.frombuffer(parents, dtype=np.int64) << 9 | np.frombuffer(symbols, dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.children = array("q", keys[order].tobytes()), array("i", (order + 1).astype(np.int32).tobytes())
        inner = np.zeros(len(self.token_at), dtype=np.uint8)
        inner[np.frombuffer(parents, dtype=np.int64)] = 1
        self.inner = inner.tobytes()

    def child(self, node: int, symbol: int) -> int:
        """Where an arc leads; 0 (the root, which no arc reaches) for none."""
        key = node << 9 | symbol
        at = bisect_left(self.keys, key)
        return self.children[at] if at < len(self.keys) and self.keys[at] == key else 0


class MergeAutomaton:
    """States and arcs after all merge gadgets, in flat arrays. Labels are token ids; state 0 is the start."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = ""):
        n = max(vocab.values()) + 1
        self.born = born = array("i", bytes(4 * n))  # 0: a base symbol
        self.left, self.live = array("i", [-1]) * n, bytearray(b"\1" * n)
        self.state = state = array("i", bytes(4 * n))  # where the arcs with this label lead
        origin, lost, since = array("i", [0]), array("i", [-1]), array("i", [0])
        made, known = bytearray(n), {}

        def arc(q: int, w: int) -> bool:
            """Whether state q has an arc w, in the automaton so far."""
            key = q << 20 | w
            has = known.get(key)
            if has is not None:
                return has
            at, birth = q, born[w]
            while since[at] > birth and lost[at] != w:  # copied when w was there: what its origin had, but for the arc it lost
                at = origin[at]
            has = since[at] <= birth and bool(self.live[w]) and (not birth or arc(at, self.left[w]))
            known[key] = has
            return has

        for rank, (a, b) in enumerate(merges, 1):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if made[w]:
                raise ValueError(f"two merges make {a + b!r}; each token needs one derivation")
            made[w] = 1
            p = state[u]
            self.live[w] = arc(p, v)
            self.left[w], born[w], state[w] = u, rank, state[v]
            if self.live[w]:
                origin.append(p)
                lost.append(v)
                since.append(rank)
                state[u] = len(origin) - 1
                if u == v:
                    state[w] = p
        self.settle(n, origin, lost, since)
        self.spell(vocab, suffix)
        self.forget()

    def settle(self, n: int, origin: array, lost: array, since: array) -> None:
        """Number the copies in pre-order, so that all copies made from one that lost an arc are an interval.

        For each label: the outermost such intervals, and when their first copy was made.
        """
        size = len(origin)
        below, counts = np.argsort(np.frombuffer(origin, np.int32)[1:], kind="stable") + 1, np.bincount(np.frombuffer(origin, np.int32)[1:], minlength=size)
        first = np.concatenate(([0], np.cumsum(counts)))
        self.place, end, todo, now = array("i", bytes(4 * size)), array("i", bytes(4 * size)), [0], 0
        while todo:
            q = todo.pop()
            if q < 0:
                end[~q] = now
                continue
            self.place[q] = now
            now += 1
            todo.append(~q)
            todo += below[first[q] : first[q + 1]].tolist()
        self.gone_at, self.gone_to, self.gone_since, self.gone = array("i"), array("i"), array("i"), array("i", bytes(4 * (n + 1)))
        label, reach = -1, 0
        for q in sorted(range(1, size), key=lambda q: (lost[q], self.place[q])):
            if lost[q] != label:
                label, reach = lost[q], 0
            if self.place[q] >= reach:
                reach = end[q]
                self.gone_at.append(self.place[q])
                self.gone_to.append(end[q])
                self.gone_since.append(since[q])
                self.gone[label + 1] += 1
        self.gone = array("i", np.cumsum(np.frombuffer(self.gone, np.int32)).astype(np.int32).tobytes())

    def arc(self, q: int, w: int) -> bool:
        """Whether state q has an arc w: nothing it was copied from had lost w, nor its left part before w was made, and so on."""
        at, until = self.place[q], 1 << 30
        while True:
            i = bisect_right(self.gone_at, at, self.gone[w], self.gone[w + 1]) - 1
            if i >= self.gone[w] and at < self.gone_to[i] and self.gone_since[i] <= until or not self.live[w]:
                return False
            until = self.born[w]
            if not until:
                return True
            w = self.left[w]

    def path(self, word: bytes) -> list[int]:
        """The labels of the one path for a word, whose last byte carries the suffix."""
        known, q, ends = self.steps.get, 0, []
        for symbol in (*word[:-1], word[-1] + 256):
            t = known(q << 9 | symbol) or self.step(q, symbol)
            q = t >> 36
            ends.append(t & _END)
        if len(self.steps) > MAX_STEPS:
            self.forget()
        i, out = len(word), []
        while i:
            t = ends[i - 1]
            out.append(t >> 16)
            i -= t & 0xFFFF
        return out[::-1]

    def forget(self) -> None:
        """Empty the table of steps; configuration 0 is the beginning of a word."""
        start = array("q", [0]).tobytes()
        self.configs, self.numbers, self.steps = [start], {start: 0}, {}

    def step(self, q: int, symbol: int) -> int:
        """Enter what reading a symbol in a configuration does: next configuration, arc that ends here, its length.

        A configuration is the places in the labels' trie of all arcs that may be under way, each with its state, as
        one string of 64-bit integers; a step is one integer.
        """
        going, ends, trie = array("q"), None, self.trie
        for pair in array("q", self.configs[q]):
            child = trie.child(pair >> 24, symbol)
            if child:
                w = trie.token_at[child]
                if w >= 0 and ends is None and self.arc(pair & 0xFFFFFF, w):
                    ends = (w, trie.depth[child])
                if trie.inner[child]:
                    going.append(child << 24 | pair & 0xFFFFFF)
        if ends is None:
            if symbol >= 256 or not going:
                raise ValueError("no path: the vocabulary lacks a symbol")
        else:
            going.append(self.state[ends[0]])
        config = going.tobytes()
        number = self.numbers.get(config)
        if number is None:
            number = self.numbers[config] = len(self.configs)
            self.configs.append(config)
        w, length = ends or (0, 0)
        found = self.steps[q << 9 | symbol] = number << 36 | w << 16 | length
        return found

    def spell(self, vocab: dict[str, int], suffix: str) -> None:
        """Enter all labels in the trie; without a suffix, a label may end a word or not."""
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        words = []
        for label, w in vocab.items():
            last = bool(suffix) and label.endswith(suffix)
            symbols = [byte_of[c] for c in (label[: -len(suffix)] if last else label)]
            spelt = array("H", symbols)
            for end in ((256,) if last else (0,)) if suffix else (256, 0):
                spelt[-1] = symbols[-1] + end
                words.append((np.array(spelt, dtype=">u2").tobytes(), w))
        self.trie = Trie(words)


class Encoder:
    """A vocabulary file's text preparation around its automaton."""

    def __init__(self, spec: dict):
        model = spec["model"]
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        split = [x for x in spec["pre_tokenizer"].get("pretokenizers", []) if x["type"] == "Split"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or len(split) != 1 or not split[0]["invert"]:
            raise ValueError("expected a BPE file with NFC, white space, lower case and one split pattern")
        self.suffix = model["end_of_word_suffix"] or ""
        self.automaton = MergeAutomaton(model["vocab"], (m if isinstance(m, list) else m.split(" ") for m in model["merges"]), self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(split[0]["pattern"]["Regex"].replace(r"\s", SPACE)).findall
        self.pieces = regex.compile(f"[^{SPACE}]+").findall
        labels = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.labels = np.array([labels.get(i, "") for i in range(max(labels) + 1)], dtype=object)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def release(self) -> None:
        """Give back the texts' pieces; the automaton stays, with its steps, which are bounded and dear to find again."""
        self.known, self.before = {}, {}

    def piece(self, piece: str) -> bytes:
        """Ids, as 32-bit integers, of a prepared text without white space."""
        out = self.before.get(piece)
        if out is None:
            ids: list[int] = []
            for word in self.words(piece):
                ids += self.automaton.path(word.encode())
            out = array("i", ids).tobytes()
        if len(piece) <= MAX_PIECE:
            if len(self.known) >= MAX_PIECES:
                self.known, self.before = {}, self.known
            self.known[piece] = out
        return out

    def prepared(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower case is by character here, with no final form
                text = text.replace("Σ", "σ")
        text = text.lower()
        return self.pieces(text) if not text.isascii() or _ODD.search(text) else text.split()

    def encode(self, text: str) -> bytes:
        def ids_of(text: str) -> list[bytes]:
            get, piece = self.known.get, self.piece
            return [get(p) or piece(p) for p in self.prepared(text)]

        if self.cut is not None and "<" in text and self.cut.search(text):
            out = []
            for part in self.cut.split(text):
                if part in self.special:
                    out.append(array("i", [self.special[part]]).tobytes())
                else:
                    out += ids_of(part)
            return b"".join(out)
        return b"".join(ids_of(text))

    def decode(self, ids: np.ndarray) -> str:
        """The labels of the ids' arcs; a file without a decoder puts one space between them."""
        return " ".join(self.labels[ids].tolist())


_compiled: dict[str, Encoder] = {}  # of one vocabulary file: what a worker keeps between tasks


@contextmanager
def _encoder(spec: str) -> Iterator[Encoder]:
    """The compiled file for one task; the pieces that the task has met are released at its end."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _compiled:
        _compiled.clear()
        encoder = Encoder(json.loads(spec))
        _compiled[name] = encoder
    try:
        yield _compiled[name]
    finally:
        if name in _compiled:
            _compiled[name].release()
        gc.collect()


def _spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _encoded(part: pa.RecordBatch, text_col: str, encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    ids = [encoder.encode(t) if t else b"" for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
    return np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))), np.frombuffer(b"".join(ids), dtype=np.int32)


def _id_field(df: DataFrame, id_col: str) -> T.StructField:
    return T.StructField(id_col, df.schema[id_col].dataType)


def encode(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """id, ids array<int> and, if asked for, the decoded text of each document's ids."""
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(_spec(vocabulary))  # one vocabulary file

    def run(batches):
        with _encoder(shared.value) as encoder:
            for batch in batches:
                for part, _, _ in slices(batch, text_col):
                    offsets, ids = _encoded(part, text_col, encoder)
                    columns = [part.column(part.schema.get_field_index(id_col)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))]
                    if decoded:
                        columns.append(pa.array([encoder.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "decoded"][: len(columns)])

    fields = [_id_field(documents, id_col), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    return documents.select(id_col, text_col).mapInArrow(run, T.StructType(fields + [T.StructField("decoded", T.StringType())] * decoded))


def decode(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and the text that the ids' labels spell; null ids give the empty text."""
    ship(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(_spec(vocabulary))

    def run(batches):
        with _encoder(shared.value) as encoder:
            for batch in batches:
                texts = [encoder.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, T.StructType([_id_field(encoded, id_col), T.StructField("decoded", T.StringType())]))


def report(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of `encode`: n_tokens, ids_sha256 and decoded_sha256."""
    return encode(documents, vocabulary, id_col, text_col, decoded=True).select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
