"""BPE against the tokenizers library, packing against best-fit decreasing piece by piece."""

import hashlib
import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from alertlake.llm import bpe, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
DOCS = "doc_id long, text string, ids string, piece string, n_tokens string"


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def _texts():
    random.seed(6)
    codes = [*range(0x250), *range(0x370, 0x400), *range(0x2000, 0x2070), 0x300, 0x301, 0x130, 0x1E9E, 0xFB01, 0x4E00,
             0xAC00, 0x1F600, 0x3000, 0x1680, 0x85, 0x1C, 0x1F, 0x180E, 0xFEFF]
    texts = ["".join(chr(random.choice(codes)) for _ in range(random.randrange(40))) for _ in range(300)]
    texts += ["a<|endoftext|>b", "<|endoftext|><|startoftext|>", "x <|endoftext|", "<|ENDOFTEXT|>", "aaaaaaaaaaaaa", "",
              "'s'S!'s it's I'LL", "ΑΣ ΣΑΣ", "   ", "lll aaa aaaa ababab", "th" * 3000, "=" * 501, "Over and " * 4000, None]
    return texts + texts[:20]


def test_ids_and_decoded_texts_equal_the_library(spark):
    texts = _texts()
    docs = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in enumerate(texts)], DOCS)
    encoded = bpe.encode(docs, PATH)
    assert {r.doc_id: r.ids for r in encoded.collect()} == {i: _ids(t) for i, t in enumerate(texts)}
    decoded = {r.doc_id: r.text for r in bpe.decode(encoded, PATH).collect()}
    assert decoded == {i: LIBRARY.decode(_ids(t), skip_special_tokens=False) for i, t in enumerate(texts)}
    want = [(i, len(_ids(t)), hashlib.sha256(" ".join(map(str, _ids(t))).encode()).hexdigest(),
             hashlib.sha256(decoded[i].encode()).hexdigest()) for i, t in enumerate(texts)]
    assert sorted(tuple(r) for r in bpe.digests(docs, PATH).collect()) == want
    assert bpe.digests(docs.limit(0), PATH).count() == 0


def _differing(texts):
    """Texts whose ids differ from the library's."""
    own = bpe.encoder(PATH)
    split, words, ids, begin = own.block(texts)
    of = {w: ids[a:b].tolist() for w, a, b in zip(words, begin, begin[1:])}
    want = LIBRARY.encode_batch(texts, add_special_tokens=False)
    return [t for t, s, e in zip(texts, split, want) if [i for w in s for i in of[w]] != e.ids]


@pytest.mark.parametrize("shape", ["%s", "a%sb", "x%s%s1 %s."])
def test_every_code_point_is_cut_as_the_library_does(shape):
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for at in range(0, len(points), 50_000):
        assert _differing([shape.replace("%s", c) for c in points[at:at + 50_000]]) == []


def test_sequences_of_marks_are_composed_as_the_library_does():
    import unicodedata

    rng = random.Random(1)
    marks = [chr(i) for i in range(0x110000) if unicodedata.combining(chr(i))] + [chr(i) for i in (*range(0x1AB0, 0x1B00), 0x200D)]
    letters = "aeouAEIOUncsΑΩαωΣЖиИ가힣한각1. "
    assert _differing(["".join(rng.choice(letters) + "".join(rng.choices(marks, k=rng.randint(0, 3))) for _ in range(rng.randint(1, 4)))
                       for _ in range(100_000)]) == []


@pytest.mark.parametrize("most", [0, 200, 1 << 20])
def test_words_known_from_former_blocks_keep_their_ids(monkeypatch, most):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", most)
    own, texts = bpe.Encoder(PATH), [*_texts(), "a\x1cb <|endoftext|>", " \x1f", " a  b ", "x\u2003y\u0085"]
    for at in [*range(0, len(texts), 40), 0]:
        part = texts[at:at + 40]
        assert [x.tolist() for x in own.text_ids(pa.array(part, pa.string()))] == [_ids(t) for t in part]
        assert len(own.known) <= most and all(len(w) <= bpe.KNOWN_LENGTH for w in own.known)
    assert own.text_ids(pa.array([], pa.string())) == []


@pytest.mark.parametrize("shape", ["%s", "a%sb"])
def test_texts_of_every_code_point_have_the_librarys_ids(shape):
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    own = bpe.encoder(PATH)
    for at in range(0, len(points), 200_000):
        texts = [shape.replace("%s", c) for c in points[at:at + 200_000]]
        got = own.text_ids(pa.array(texts))
        assert [t for t, g, e in zip(texts, got, LIBRARY.encode_batch(texts, add_special_tokens=False)) if g.tolist() != e.ids] == []


def _rooms(plan, pieces):
    filled: dict[int, int] = {}
    ends = [*plan[1:, 0].tolist(), pieces]
    for (rank, length, each, first, offset), end in zip(plan.tolist(), ends):
        for k in range(end - rank):
            assert filled.get(first + k // each, 0) == offset + k % each * length
            filled[first + k // each] = offset + k % each * length + length
    return sorted(pack.CAPACITY - x for x in filled.values())


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    random.seed(seed)
    lengths = [random.choice([1, 2, 50, 500, 700, 1000, 2047, 2048, random.randrange(1, 2049)])
               for _ in range(random.randrange(300))]
    assert _rooms(pack.best_fit(dict(Counter(lengths))), len(lengths)) == pack.brute_force(lengths)


def test_packed_pieces_are_whole(spark):
    texts = _texts()
    docs = spark.createDataFrame([(None if i == 3 else i, t, "clash", "clash", "clash") for i, t in enumerate(texts)], DOCS)
    rows = pack.pack_documents(docs, PATH).collect()
    assert len(rows) == sum(-(-(len(_ids(t)) + 1) // 2048) for t in texts)
    for i, t in enumerate(texts):
        ids = [*_ids(t), 0]
        for r in (r for r in rows if r.doc_id == (None if i == 3 else i)):
            part = ids[r.start:r.start + r.length]
            assert r.start == 2048 * r.piece and r.length == len(part)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
    places: dict = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert places.get(r.sequence_id, 0) == r.offset
        places[r.sequence_id] = r.offset + r.length
    assert max(places.values()) <= 2048
    assert sorted(2048 - x for x in places.values()) == pack.brute_force([r.length for r in rows])
    assert pack.pack_documents(docs.limit(0), PATH).count() == 0
