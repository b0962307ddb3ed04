"""Words whose polynomial hashes agree modulo 2^64 whatever the base: the Thue-Morse word and its complement."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fieldtally.llm import bytescan, context_tree, jaccard, packing, token_store, tokens


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


PAIRS = [(thue_morse(n), thue_morse(n, "ba")) for n in (1024, 2048)]


def spans(texts, **options):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in texts])
    return bytescan.Hashed(data, **options).spans(np.concatenate([[0], ends[:-1]]), ends)


@pytest.mark.parametrize("pair", PAIRS)
def test_safe_hashes_tell_them_apart_and_do_not_depend_on_the_place(pair):
    plain = spans(pair)
    assert plain[0] == plain[1]  # what the safe ones are for
    safe = spans([*pair, "x", *pair, ""], safe=True)
    assert safe[0] == safe[3] and safe[1] == safe[4] and len(set(safe.tolist())) == 4
    folded = spans([*pair, pair[0].upper()], values=bytescan.FOLDED, safe=True)
    assert folded[0] == folded[2] != folded[1]


def test_safe_hashes_of_long_buffers():
    rng = np.random.default_rng(3)
    word = rng.integers(0, 256, 40).astype(np.uint8)
    data = rng.integers(0, 256, 3_000_000).astype(np.uint8)
    at = np.array([0, 17, 1_234_567, 2_999_960])
    for a in at:
        data[a: a + 40] = word
    at = np.delete(at, [0])  # the first copy is overwritten by the second
    assert len(set(bytescan.Hashed(data, safe=True).spans(at, at + 40).tolist())) == 1


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("pair", PAIRS)
def test_encoder(name, pair):
    tokenizer = Tokenizer.from_file(tokens.vocabulary(name))
    coder = tokens.Encoder(name, 9)
    data, at = bytescan.buffers(pa.array([f"{a} {b}" for a, b in (pair, pair[::-1])]))
    ids, begins = coder.encode(data, at)
    for i, text in enumerate((f"{pair[0]} {pair[1]}", f"{pair[1]} {pair[0]}")):
        assert ids[begins[i]: begins[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [9]


def test_store_and_packing(spark, docs, tmp_path):
    rows = docs(*[(i, t) for i, t in enumerate(w for pair in PAIRS for w in pair)], parts=1)
    token_store.write(rows, str(tmp_path / "store"), vocabulary="byte_bpe_50k.json", end=2)
    got = {r.doc_id: r.ids_crc32 for r in token_store.crc32_of(token_store.read(spark, str(tmp_path / "store"))).collect()}
    assert len(set(got.values())) == 4
    pieces = packing.cut(rows, vocabulary="word_bpe_49k.json", end=1, capacity=4096).collect()
    assert len({bytes(r.ids) for r in pieces}) == len(pieces) == 4


def test_words_of_the_language_model(docs):
    first, second = PAIRS[0]
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    train = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 != 0)
    got = {r.doc_id: r.n_known for r in context_tree.score(docs((train, first), (held, second))).collect()}
    assert got == {train: 2, held: 1}


def test_grams_of_the_join(docs):
    rows = [(1, PAIRS[0][0]), (2, PAIRS[0][1]), (3, PAIRS[0][0])]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(docs(*rows, parts=1), n=5, threshold=0.8, recall=0.999).collect()}
    assert got == {1: (1, 1), 2: (2, 0), 3: (1, 1)}
