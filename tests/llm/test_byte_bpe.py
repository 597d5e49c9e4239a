"""Byte-level BPE against the tiktoken library, decoding against Python's."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from terrier.llm import byte_bpe, queries

FOLDER = "/root/testdata/sf0.01"
PATTERN = public_tokenizers.PATTERN
NAMES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "\n\n \t", "Hello world", "it's we'll I'D", "<|endoftext|> x", "é" * 50, "日本語のテキスト", "a" * 3000,
         " " * 3000 + "x", "0123456789" * 50, "  x\x1c y", "👩‍👩‍👧 family \U0001F9FF", "aaab" * 400, "\x00\x01"]


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    path = public_tokenizers.path(request.param)
    ranks = byte_bpe.read_ranks(path)
    return byte_bpe.Encoder(ranks, PATTERN), tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), byte_bpe._tokens(path)


def agree(both, text):
    encoder, library, tokens = both
    ids = encoder.encode(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert byte_bpe._text(tokens, pa.array(ids, pa.int32())) == text


def test_given_texts(both):
    for text in TEXTS:
        agree(both, text or "")


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(max_size=60))
def test_any_text(both, text):
    agree(both, text)


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(st.sampled_from("ab'  \n\t\r\x1c\xa0\u2003\u0085.1é"), max_size=20))
def test_blanks_of_all_kinds(both, text):
    agree(both, text)
    encoder = byte_bpe.Encoder.__new__(byte_bpe.Encoder)
    encoder.__dict__ = both[0].__dict__ | {"cut_at_blanks": False}
    assert encoder.encode(text).tolist() == both[0].encode(text).tolist()


def test_joined_tokens_and_small_alphabets(both):
    chance = random.Random(5)
    tokens = list(both[0].transducer.ranks)
    for _ in range(1500):
        agree(both, b"".join(chance.choices(tokens, k=chance.randint(1, 5))).decode("utf-8", "ignore"))
    for letters in ("ab", "aeiou st", "abcdefghijklmnopqrstuvwxyz", "=-_*#", "äöüßé", "\n \t"):
        for _ in range(200):
            agree(both, "".join(chance.choices(letters, k=chance.randint(1, 80))))


def test_a_small_automaton_starts_anew(both, monkeypatch):
    monkeypatch.setattr(byte_bpe, "STATES", 50)
    encoder = byte_bpe.Encoder(both[0].transducer.ranks, PATTERN)
    for recent in (encoder.recent_pieces, encoder.recent_stretches):
        recent.size = 2
    for text in ("unbelievably incomprehensible words", "xqzjk vwpfm brgtl", "unbelievably") * 3:
        assert encoder.encode(text).tolist() == both[1].encode_ordinary(text)
    assert len(encoder.transducer.states) < 400


def test_tokens_leave_after_a_bounded_lookahead(both):
    """What waits in a state is never longer than the longest token."""
    transducer = byte_bpe.Transducer(both[0].transducer.ranks)
    longest = max(map(len, transducer.ranks))
    transducer.encode(("the quick brownfox" * 200).encode())
    waiting = [sum(len(transducer.tokens[t]) for t in w) for paths, _ in transducer.states for _, w in paths]
    assert max(waiting) <= 2 * longest


def test_a_vocabulary_whose_token_only_stands_for_a_whole_piece():
    """``abc`` cannot be reached by merging; it is a token of the piece ``abc`` only."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bcd": 256, b"abc": 257, b"cd": 258, b"xabc": 259}
    transducer = byte_bpe.Transducer(ranks)
    library = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    for piece in ("abc", "abcd", "xabc", "aabc", "bcd", "cd", "abccd", "xabcd"):
        assert transducer.encode(piece.encode()) == library.encode_ordinary(piece), piece


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=24), st.lists(st.integers(1, 5), min_size=24, max_size=24))
def test_decoding_in_steps_equals_decoding_at_once(raw, steps):
    decoder = byte_bpe.StreamDecoder([bytes([b]) for b in range(256)])
    out, at = [], 0
    for step in steps:
        out.append(decoder.feed(list(raw[at : at + step])))
        at += step
    assert "".join([*out, decoder.end()]) == raw.decode("utf-8", "replace")


def test_frames_with_nulls_repeats_and_clashing_names(spark):
    path = public_tokenizers.path(NAMES[0])
    rows = [(i, t, "a", [1]) for i, t in enumerate(TEXTS)] + [(None, "no id", "b", None), (3, "again", "c", None)] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string, id string, ids array<int>").repartition(3)
    ids = byte_bpe.encoded(frame, path, PATTERN)
    got = sorted((str(r.id), r.text) for r in byte_bpe.decoded(ids, path).collect())
    assert got == sorted((str(i), t or "") for i, t, *_ in rows)
    both = byte_bpe.encoded(frame, path, PATTERN, with_text=True)
    assert sorted((str(r.id), r.text) for r in both.collect()) == got
    assert byte_bpe.decoded(byte_bpe.encoded(frame.limit(0), path, PATTERN), path).collect() == []
    none = spark.createDataFrame([(1, None), (2, [])], "id long, ids array<int>")
    assert [r.text for r in byte_bpe.decoded(none, path).collect()] == ["", ""]


def test_foreign_ids_are_refused():
    tokens = byte_bpe._tokens(public_tokenizers.path(NAMES[0]))
    for wrong in ([60000], [-1], [None]):
        with pytest.raises(ValueError):
            byte_bpe._text(tokens, pa.array(wrong, pa.int32()))


def test_query_equals_the_library(spark, documents):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(NAMES[0]))
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, _ in documents:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(t)))
    assert sorted(tuple(r) for r in queries.op12_byte_bpe(spark, FOLDER).collect()) == want
