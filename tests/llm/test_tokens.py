import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import edge_rows, make_docs  # noqa: F401
from tokenizers import Tokenizer

from quarry.llm.bpe import WordBpe
from quarry.llm.bpe_roundtrip import Speculator, encode_documents
from quarry.llm.packing import SpacedTokenizer, pack_documents, plan
from quarry.llm.token_counts import Counter, token_counts

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def spec(path):
    with open(path, encoding="utf-8") as fh:
        return fh.read()


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


def odd_texts(n, seed):
    rnd = random.Random(seed)
    letters = "abcdeéñ'sſKΣσ1٣ \t\n\x0b\x1c\x85 　́ßİ<|>!?é漢字🙂​#.,  "
    extra = ["<|endoftext|>", "<|startoftext|>", "'s", "'ll", "<|endoftext", "ǅ", "ﬁ", "aaaa", "the", "  ", "\n\n", " \n", "Thing,"]
    for _ in range(n):
        yield "".join(rnd.choice(letters) if rnd.random() < 0.7 else rnd.choice(extra) for _ in range(rnd.randrange(0, 50)))


def test_transducer_counts_odd_texts(word):
    counter = Counter(spec(WORD))
    for text in odd_texts(3000, 1):
        assert counter.of_text(text.encode()) == len(word.encode(text, add_special_tokens=False).ids), text


def test_transducer_long_words_and_state_maps(word):
    counter = Counter(spec(WORD))
    rnd = random.Random(3)
    for text in ("a" * 5000, "abracadabra" * 900, "x y " * 50_000, "".join(rnd.choice("etaoin") for _ in range(70_000)), ("ab " + "é" * 70_000) * 2):
        assert counter.of_text(text.encode()) == len(word.encode(text, add_special_tokens=False).ids)


def test_compatible_means_merging_changes_nothing():
    bpe = WordBpe(spec(WORD))
    rnd = random.Random(5)
    plain = [t for t in bpe.ids if not t.endswith(bpe.end) and bpe.merge(bpe.split_token(t)) == [t]]
    final = [t for t in bpe.ids if t.endswith(bpe.end) and t != bpe.end and bpe.merge(bpe.split_token(t)) == [t]]
    for _ in range(4000):
        a, b = rnd.choice(plain), rnd.choice(plain if rnd.random() < 0.5 else final)
        assert bpe.compatible(a, b) == (bpe.merge(bpe.split_token(a) + bpe.split_token(b)) == [a, b]), (a, b)
    long = [*"abracadabra" * 20]
    assert bpe.merge(long) == bpe._merge_long(long)


def test_token_counts_frame(make_docs, edge_rows, word):
    want = sorted(((i, len((t or "").encode()), n := len(word.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in edge_rows), key=repr)
    assert sorted((tuple(r) for r in token_counts(make_docs(edge_rows), WORD).collect()), key=repr) == want
    assert token_counts(make_docs(edge_rows).limit(0), WORD).collect() == []


def test_speculator_with_small_caches(word):
    s = Speculator(spec(WORD))
    s.pieces.most = s.words.most = 60
    texts = list(odd_texts(600, 7))
    for k in range(0, len(texts), 25):
        for text, found in zip(texts[k : k + 25], s.encode([t.encode() for t in texts[k : k + 25]]), strict=True):
            assert np.frombuffer(b"".join(e[0] for e in found), "<u4").tolist() == word.encode(text, add_special_tokens=False).ids
    assert 0 < s.exact_words < s.proposed_words  # some words fail verification, most do not need merging


def test_roundtrip_frame(make_docs, edge_rows, word):
    rows = encode_documents(make_docs(edge_rows), WORD).collect()
    want = []
    for i, t in edge_rows:
        ids = word.encode(t or "", add_special_tokens=False).ids
        text = word.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids, text))
    assert sorted((tuple(r) for r in rows), key=repr) == sorted(want, key=repr)
    assert encode_documents(make_docs(edge_rows).limit(0), WORD).collect() == []


def test_spaced_tokenizer_is_the_library(byte):
    t = SpacedTokenizer(spec(BYTE))
    t.units.most = 200
    texts = list(odd_texts(3000, 9)) + ["plain words, and\nlines.  Two spaces \n don't 123!! ¿Qué?"]
    for k in range(0, len(texts), 10):
        for text, ids in zip(texts[k : k + 10], t.encode(texts[k : k + 10]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == byte.encode(text, add_special_tokens=False).ids, text


def test_spaced_tokenizer_holds_few_units(byte):
    t = SpacedTokenizer(spec(BYTE))
    most, letters = 0, str.maketrans("0123456789", "ghijklmnop")
    for k in range(0, 320_000, 40_000):
        texts = [" ".join(f"{i:x}".translate(letters) for i in range(j, j + 400)) for j in range(k, k + 40_000, 400)]
        found = t.encode(texts)
        most = max(most, t.units.given)
        assert np.frombuffer(found[7], "<u4").tolist() == byte.encode(texts[7], add_special_tokens=False).ids
    assert 0 < most < 300_000


def check_packing(rows, docs, byte, capacity=2048):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i in {i for i, _ in docs}:
        texts = [t or "" for j, t in docs if j == i]
        ids = byte.encode(texts[0], add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[i], key=lambda r: (r.piece, r.sequence_id, r.offset))
        starts = sorted({p.start for p in pieces})
        assert len(pieces) == len(texts) * len(starts)
        assert sum({p.start: p.length for p in pieces}.values()) == len(ids)
        for p in pieces:
            assert p.piece == 0 or p.length == capacity
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing_frame(make_docs, edge_rows, byte):
    docs = make_docs(edge_rows)
    check_packing(pack_documents(docs, BYTE).collect(), edge_rows, byte)
    assert pack_documents(docs.limit(0), BYTE).collect() == []


def test_packing_a_hot_length(make_docs, byte):
    rows = [(i, "same length") for i in range(700)] + [(1000 + i, "word " * (i % 90)) for i in range(300)]
    packed = pack_documents(make_docs(rows), BYTE, capacity=64).collect()
    check_packing(packed, rows, byte, 64)
    total = sum(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= -(-total // 64) * 1.02 + 1


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(11)
    for _ in range(60):
        capacity = rnd.choice([7, 16, 50])
        histogram = {rnd.randint(1, capacity): rnd.randint(1, 40) for _ in range(rnd.randint(1, 12))}
        rooms = []  # plain best-fit decreasing, one piece at a time
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                fits = [r for r in rooms if r >= length]
                if fits:
                    rooms.remove(min(fits))
                    rooms.append(min(fits) - length)
                else:
                    rooms.append(capacity - length)
        used = {}
        for length, begin, end, first, each, at in plan(histogram, capacity):
            for rank in range(begin, end):
                k = rank - begin
                used.setdefault(first + k // each, []).append((at + k % each * length, length))
        assert len(used) == len(rooms)
        assert sum(map(len, used.values())) == sum(histogram.values())
        assert sorted(capacity - sum(n for _, n in places) for places in used.values()) == sorted(rooms)
