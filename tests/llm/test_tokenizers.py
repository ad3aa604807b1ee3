"""Token counts and SentencePiece encoding, held against the public libraries."""
import random

import numpy as np
import public_tokenizers as public
import pytest

from lotwise.llm import sentencepiece_unigram as sp
from lotwise.llm import token_counts as tc
from lotwise.llm.double_array import DoubleArrayTrie, by_length, spans

ODD = list("aábcthe rsvmdl'’ \n\t\r\x0b\x1c\x85\xa0 　 0123½²٣日本кот😀é!?.,$%<|>") + [
    "<|endoftext|>", "'s", "'re", "   ", " don't", "\x00", "▁", " the", "ing"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 70))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocabulary():
    return tc.Vocabulary.from_file(public.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def pieces():
    return sp.Pieces.from_file(public.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def unigram_library(pieces):
    """The library's own unigram model of the same pieces and scores."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor
    model = pb.ModelProto()
    with open(public.path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1
    for piece, score, kind in zip(model.pieces, pieces.scores, pieces.kinds):
        if kind == "normal":
            piece.score, piece.type = score, 1
    return SentencePieceProcessor(model_proto=model.SerializeToString())


def test_counts_match_the_library_whatever_the_chunks(vocabulary, library):
    machine, rng = tc.WordTransducer(vocabulary), random.Random(2)
    texts = odd_texts(600)
    want = [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
    assert machine.counts(texts) == want
    assert [machine.count(t, rng.randint(1, 20)) for t in texts] == want


def test_scan_is_the_fold_of_each_prefix(vocabulary):
    machine = tc.WordTransducer(vocabulary)
    text = " ".join(odd_texts(20, 3))
    maps = [machine.chunk_map(text[i:i + 7]) for i in range(0, len(text), 7)]
    scanned = machine.scan(maps)
    assert scanned[-1] == machine.fold(maps)
    assert scanned[4] == machine.fold(maps[:5])


def test_byte_transducer_agrees_with_lockstep(vocabulary):
    machine = tc.PreTokenCounter(vocabulary)
    words = sorted({w for t in odd_texts(300, 4) for w in machine_words(t)})
    assert machine.counts(words) == [machine.bpe.count(w.encode()) for w in words]


def machine_words(text):
    import regex
    return regex.findall(tc.PRE_TOKENS, text)


def test_long_pre_tokens(vocabulary, library):
    machine = tc.WordTransducer(vocabulary)
    for text in ("a" * 20000, "theandere" * 3000, " " * 5000 + "x", "\n \n" * 2000):
        assert machine.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_count_tokens_defined_cases(spark, store, vocabulary, library, words):
    long = words(5, 60000)
    rows = [(1, None, "a"), (2, "", "b"), (3, "Hello  world", "c"), (3, "Hello  world", "c"),
            (None, long, None), (5, "x<|endoftext|>y", "d")]
    docs = store(spark, rows, "doc_id long, text string, N_TOKENS string")
    out = tc.count_tokens(docs, vocabulary)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = sorted(map(tuple, out.collect()), key=repr)

    def want(text):
        return len(library.encode(text or "", add_special_tokens=False).ids)

    assert got == sorted([(i, len((t or "").encode()), want(t), want(t) > 1024)
                          for i, t, _ in rows], key=repr)
    assert tc.count_tokens(docs.limit(0), vocabulary).count() == 0


def test_double_array_finds_all_keys():
    keys = {w.encode(): i for i, w in enumerate(["a", "ab", "abc", "b", "bca", "é", "c" * 30])}
    trie = DoubleArrayTrie(keys)
    words = [b"abca", "éab".encode(), b"", b"zz", b"c" * 45]
    found = set()
    for chosen, matrix, lengths in by_length(words):
        for rows, start, end, value in spans(trie, matrix, lengths):
            found |= {(int(chosen[r]), start, end, int(v)) for r, v in zip(rows, value)}
    want = {(i, s, e, keys[w[s:e]]) for i, w in enumerate(words) for s in range(len(w))
            for e in range(s + 1, len(w) + 1) if w[s:e] in keys}
    assert found == want


def ids(codec, text):
    return np.frombuffer(codec.encode([text])[0], np.int32).tolist()


def test_viterbi_matches_the_library(pieces, unigram_library):
    """Up to paths of equal score, of which the library's 32-bit sums take either."""
    codec = sp.UnigramCodec(pieces)
    for text in odd_texts(600, 5):
        own, other = ids(codec, text), unigram_library.encode(text)
        if own != other:
            gain = sum(pieces.scores[i] for i in own) - sum(pieces.scores[i] for i in other)
            assert abs(gain) < 1e-3
        assert codec.decode(own) == unigram_library.decode(own)


def test_lockstep_agrees_with_plain_viterbi(pieces):
    codec = sp.UnigramCodec(pieces)
    words = sorted({w for t in odd_texts(300, 6) for w in codec.words("▁" + t.replace(" ", "▁"))})
    packed = codec._pack(words)
    assert [np.frombuffer(p, np.int32).tolist() for p in packed] == [
        codec.segment(w) for w in words]


def test_round_trip_and_defined_cases(spark, store, pieces, words):
    rows = [(1, None, "a"), (2, "", "b"), (3, "Hello  wörld\n😀", "c"), (None, words(7, 40000), "d"),
            (4, "x" * 100000, "e"), (4, "x" * 100000, "e")]
    docs = store(spark, rows, "doc_id long, text string, PIECE_IDS string")
    out = sp.decode(sp.encode(docs, pieces), pieces)
    assert out.columns == ["doc_id", "text", "piece_ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r.decoded == (r.text or "") for r in got)
    assert {len(r.piece_ids) for r in got if not r.text} == {0}
    assert sp.encode(docs.limit(0), pieces).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "piece_ids array<int>")
    assert [r.decoded for r in sp.decode(nulls, pieces).collect()] == ["", ""]
