"""BPE encoding and decoding with a pair occurrence index.

The tokenizer's merges are applied to all different words of a block of texts at once.  An
index maps each adjacent pair to all its positions.  Active ranks are taken in ascending order;
one step merges all positions of a rank, and the pairs that this makes are added to the lists of
their ranks.  Words do not influence each other, so every word sees its own merges in ascending
order, leftmost first, as the tokenizer applies them.

The tokenizer is a JSON file of the ``tokenizers`` library: byte symbols, an end-of-word suffix,
NFC, white space dropped and lower case.  Special tokens in a text are single ids.  What is a letter or a
number, and what a character's lower case and composed form are, follows the library's version of Unicode: words
with characters from U+0180 on are normalised and cut by the library's own normaliser and pre-tokeniser.
Encoding itself is done here.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertlake.llm.common import bound_batches, slices

#: Bytes of texts whose words are indexed together.
BLOCK_BYTES = 8 << 20
#: Words of former blocks whose ids a worker keeps at most, and the longest of them.
KNOWN_WORDS = 300_000
KNOWN_LENGTH = 64
_NONE = np.iinfo(np.int32).max
#: Fixed values of the tokenizer family: how words are cut, and white space.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}]+")
_SPACE = ((9, 13), (32, 32), (0x85, 0x85), (0xa0, 0xa0), (0x1680, 0x1680), (0x2000, 0x200a),
          (0x2028, 0x2029), (0x202f, 0x202f), (0x205f, 0x205f), (0x3000, 0x3000))
_WORDS = regex.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _SPACE) + "]+")
_MARKS = ".,;:!?"
#: Control characters that str.split() takes for white space and the tokenizer does not.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """A tokenizer file, ready to encode the words of texts and to decode ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        size = 1 + max(*vocab.values(), *self.special.values())
        self.tokens = [b""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token.encode()
        self.decimal = [str(i).encode() for i in range(size)]
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        symbols = _byte_symbols()
        self.byte_of = {ord(c): b for b, c in enumerate(symbols)}
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        pairs = self.left << 32 | self.right
        self.pairs, first = np.unique(pairs, return_index=True)
        self.ranks = first.astype(np.int32)
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """A text's words; a special token is a word of its own."""
        if "<|" in text and self.cut.search(text):
            return [w for part in self.cut.split(text)
                    for w in ([part] if part in self.special else self._plain(part))]
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        return _WORDS.findall(text) if any(c in text for c in _NOT_SPACE) else text.split()

    def _cut(self, word: str) -> list[str]:
        """The pieces of a word that are merged by themselves."""
        if not word.isascii() and max(word) >= "\u0180":
            pieces = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(word))
            return [bytes(map(self.byte_of.__getitem__, map(ord, piece))).decode() for piece, _ in pieces]
        return _PIECES.findall(word.lower())  # composed already, and alike in all versions

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each word begins (one entry more than words)."""
        number: dict[str, int] = {}
        parts, counts = [], []
        for w in words:
            if w.isascii():  # letters, or letters and one mark after them, need no pattern
                if w.isalpha():
                    parts.append(number.setdefault(w.lower(), len(number)))
                    counts.append(1)
                    continue
                if not w:
                    counts.append(0)
                    continue
                own = (w[:-1].lower(), w[-1]) if w[-1] in _MARKS and w[:-1].isalpha() else \
                    () if w in self.special else self._cut(w)
            else:
                own = self._cut(w)
            counts.append(len(own))
            for p in own:
                parts.append(number.setdefault(p, len(number)))
        ids, begin = self._merge([p.encode() for p in number]) if number else (np.empty(0, np.int64), np.zeros(1, np.int64))
        parts = np.array(parts, np.int64)
        size = np.diff(begin)[parts]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ends[-1]) - np.repeat(ends[:-1] - begin[:-1][parts], size)
        cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        ids, begin = ids[at], ends[cuts]
        if any(w in self.special for w in words):
            where = np.array([i for i, w in enumerate(words) if w in self.special])
            ids = np.insert(ids, begin[where], [self.special[words[i]] for i in where])
            begin = begin + np.searchsorted(where, np.arange(len(begin)))
        return ids, begin

    def _rank(self, sym: np.ndarray, nxt: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rank of the pair that begins at each position."""
        pair = sym[at] << 32 | sym[nxt[at]]
        i = np.searchsorted(self.pairs, pair)
        i[i == len(self.pairs)] = 0
        return np.where(self.pairs[i] == pair, self.ranks[i], _NONE)

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words through the pair occurrence index."""
        size = np.array([len(w) for w in words])
        ends = np.cumsum(size)
        begins = ends - size
        n = int(ends[-1])
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = np.append(self.inner[raw], -1)  # the last entry stands for "no neighbour"
        sym[ends - 1] = self.last[raw[ends - 1]]
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
        nxt[ends - 1], prv[begins] = n, n
        alive, merging = np.ones(n, bool), np.zeros(n + 1, bool)
        rank = np.append(self._rank(sym, nxt, np.arange(n)), _NONE)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, part in zip(ranks[np.append(0, cuts)].tolist(), np.split(at, cuts)):
                held = index.get(r)
                if held is None:
                    index[r] = [part]
                    heapq.heappush(active, r)
                else:
                    held.append(part)

        first = np.flatnonzero(rank[:n] != _NONE)
        if len(first):
            add(first, rank[first])
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if self.left[r] == self.right[r]:
                at = self._apart(at, nxt)
            after = nxt[at]
            beyond = nxt[after]
            sym[at] = self.merged[r]
            nxt[at] = beyond
            prv[beyond] = at
            alive[after] = False
            rank[after] = _NONE
            before = prv[at]  # no two alike; one may also be among `at`
            merging[at] = True
            changed = np.concatenate([at, before[(before < n) & ~merging[before]]])
            merging[at] = False
            now = self._rank(sym, nxt, changed)
            rank[changed] = now
            fresh = now != _NONE
            if fresh.any():
                add(changed[fresh], now[fresh])
        count = np.add.reduceat(alive, begins, dtype=np.int64)
        return sym[:n][alive], np.concatenate([[0], np.cumsum(count)])

    @staticmethod
    def _apart(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Of overlapping positions of a pair of equal symbols, every other one from the left."""
        taken, used = [], -1
        at = np.sort(at)
        for p, q in zip(at.tolist(), nxt[at].tolist()):
            if p != used:
                taken.append(p)
                used = q
        return np.array(taken)

    def block(self, texts: list[str | None]) -> tuple[list[list[str]], list[str], np.ndarray, np.ndarray]:
        """Each text's words, the different words, and these words' ids."""
        split = [self.words(t or "") for t in texts]
        distinct = list(set().union(*split))
        ids, begin = self.encode_words(distinct)
        return split, distinct, ids, begin

    def text_ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, as little-endian 32-bit numbers; null is empty and has none.

        Arrow cuts texts into words and numbers the different ones.  Texts that may hold a special token, or a character
        that only Arrow takes for white space, are cut by ``words``."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, "[" + "".join(_NOT_SPACE) + "]"))
        if not pc.any(odd).as_py():
            return self._list_ids(pc.utf8_split_whitespace(texts))
        cut = [self.words(t) for t in texts.filter(odd).to_pylist()]
        rest = iter(self._list_ids(pc.utf8_split_whitespace(texts.filter(pc.invert(odd)))))
        special = iter(self._list_ids(pa.array(cut, pa.list_(pa.string()))))
        return [next(special if x else rest) for x in odd.to_pylist()]

    def _list_ids(self, lists: pa.ListArray) -> list[np.ndarray]:
        """The ids of each list of words; an empty word has none."""
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        raw = self._raw(words)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(raw), "<u4")
        at = coded.indices.to_numpy()
        size, start = size[at], start[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)]
        lengths = pc.list_value_length(lists).to_numpy()
        begin = ends[np.concatenate([[0], np.cumsum(lengths)])].tolist()
        return [ids[a:b] for a, b in zip(begin, begin[1:])]

    def _raw(self, words: list[str]) -> list[bytes]:
        """The ids of different words as little-endian 32-bit numbers.

        Words of former blocks are not encoded again.  What is kept between blocks is bounded; beyond the bound,
        only the words of the present block stay."""
        out = list(map(self.known.get, words))
        new = [i for i, x in enumerate(out) if x is None]
        ids, begin = self.encode_words([words[i] for i in new])
        raw, at = ids.astype("<u4").tobytes(), (begin * 4).tolist()
        for i, a, b in zip(new, at, at[1:]):
            out[i] = raw[a:b]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known = {}
            new = range(len(words)) if len(words) <= KNOWN_WORDS else ()
        self.known.update((words[i], out[i]) for i in new if len(words[i]) <= KNOWN_LENGTH)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


def _per_word(words: list[str], ids: np.ndarray, begin: np.ndarray, of_id: list[bytes]) -> dict[str, bytes]:
    """For each word, what its ids stand for, joined by spaces."""
    flat, at = [of_id[i] for i in ids.tolist()], begin.tolist()
    return {w: b" ".join(flat[a:b]) for w, a, b in zip(words, at, at[1:])}


def _joined(split: list[list[str]], of_word: dict[str, bytes]) -> list[bytes]:
    """Each text's words' bytes joined by spaces; a word has one id at least."""
    return [b" ".join(map(of_word.__getitem__, words)) for words in split]


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text; null is empty and has none."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for part in slices(batches, "text", BLOCK_BYTES):
            split, words, ids, begin = own.block(part.column(1).to_pylist())
            number = {w: i for i, w in enumerate(words)}
            lists = []
            for text in split:
                spans = [number[w] for w in text]
                lists.append(np.concatenate([ids[begin[s]:begin[s + 1]] for s in spans]) if spans else ids[:0])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["id", "ids"])

    source, kind = _source(docs, id_col, text_col)
    return source.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the tokens of a row's ids, joined by spaces; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer).tokens
        for batch in batches:
            texts = [b" ".join([tokens[i] for i in ids or ()]).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    source = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    What ``encode`` and ``decode`` of each whole text give, digested in the task that made it.  A null or
    empty text, or one of white space only, has no ids and decodes to the empty text.  Equal and
    repeated rows give equal rows; other columns are not read; an empty table gives an empty result."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for part in slices(batches, "text", BLOCK_BYTES):
            split, words, ids, begin = own.block(part.column(1).to_pylist())
            size = dict(zip(words, np.diff(begin).tolist()))
            count = [sum(map(size.__getitem__, text)) for text in split]
            coded = [hashlib.sha256(x).hexdigest() for x in _joined(split, _per_word(words, ids, begin, own.decimal))]
            text = [hashlib.sha256(x).hexdigest() for x in _joined(split, _per_word(words, ids, begin, own.tokens))]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(count, pa.int64()), pa.array(coded, pa.string()), pa.array(text, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source, kind = _source(docs, id_col, text_col)
    return (source.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))


def _source(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return source, source.schema["id"].dataType.simpleString()
