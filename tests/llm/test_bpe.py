import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from amity.llm.bpe import TreeEncoder, decode_documents, encode_documents, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
with open(PATH, "rb") as _file:
    RANKS = read_ranks(_file.read())
PLAIN = tiktoken.Encoding(
    "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
TREE = TreeEncoder(RANKS, leaf_bytes=4)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text("ab", max_size=300), st.text("etaoins -=", max_size=120)))
def test_tree_is_the_plain_encoding(text):
    pieces = regex.findall(public_tokenizers.PATTERN, text)
    assert [i for p in pieces for i in TREE[p]] == PLAIN.encode_ordinary(text)
    if text:
        assert [RANKS[t] for t in TREE.encode(text.encode())] == PLAIN._encode_single_piece(text.encode())


def test_every_token_is_its_own_encoding():
    merge = TreeEncoder({}).merge  # without the look-up of the whole piece
    for token in list(RANKS)[::37]:
        encoder = TreeEncoder({k: v for k, v in RANKS.items() if v <= RANKS[token]} if len(token) == 2 else RANKS)
        assert encoder.merge(token) == [token]
    assert merge(b"ab") == [b"a", b"b"]


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "=" * 4097, " " * 3000, "x" + "é" * 2500])
def test_long_runs(text):
    assert [RANKS[t] for t in TREE.encode(text.encode())] == PLAIN._encode_single_piece(text.encode())


def test_documents(spark):
    texts = [None, "", "  two  blanks \n\n end ", "<|endoftext|> it's 1234", "word " * 4000, "same", "same", "中文\U0001f600é"]
    docs = spark.createDataFrame(
        [(i, t, [i], b"x") for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>, decoded binary"
    )
    rows = decode_documents(encode_documents(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert [r.ids for r in rows] == [PLAIN.encode_ordinary(t or "") for t in texts]
    assert [bytes(r.decoded).decode() for r in rows] == [t or "" for t in texts]
    assert encode_documents(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_vocabularies_that_begin_alike():
    """Of the same length, with the same first bytes, and other ranks at the end."""
    from base64 import b64encode

    from amity.llm.bpe import _encoder

    tokens = [bytes([i]) for i in range(256)]

    def vocabulary(*last):
        return b"\n".join(b64encode(t) + b" %d" % i for i, t in enumerate([*tokens, *last]))

    assert list(_encoder(vocabulary(b"ab", b"cd"))["abcd"]) == [256, 257]
    assert list(_encoder(vocabulary(b"cd", b"ab"))["abcd"]) == [257, 256]


def test_caches_are_bounded_in_memory():
    import random
    import tracemalloc

    random.seed(3)
    encoder = TreeEncoder(RANKS)
    tracemalloc.start()
    try:
        base = tracemalloc.get_traced_memory()[0]
        for _ in range(300_000):
            piece = " " + "".join(random.choice("abcdefghij%") for _ in range(random.randint(3, 10)))
            assert [RANKS[t] for t in encoder.encode(piece.encode())] == list(encoder[piece])
        held = tracemalloc.get_traced_memory()[0] - base
    finally:
        tracemalloc.stop()
    assert held < 50_000_000  # the worker keeps it between tasks; six workers share an executor
