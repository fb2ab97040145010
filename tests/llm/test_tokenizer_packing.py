import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silsila.llm.packing import containers, pack_sizes
from silsila.llm.tokenizer import encode_column, encoder, vocabulary_path

pytestmark = pytest.mark.skipif(not os.path.exists(vocabulary_path()), reason="no vocabulary file")


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    public = Tokenizer.from_file(vocabulary_path())
    public.encode_special_tokens = True
    return encoder(vocabulary_path()), public


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(both, text):
    own, public = both
    ids = own.encode(text)
    assert ids == public.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abeinorst '\n", max_size=120))
def test_words(both, text):
    own, public = both
    assert own.encode(text) == public.encode(text, add_special_tokens=False).ids


def test_special_strings_and_runs(both):
    own, public = both
    for text in ("<|endoftext|>", "x<|endoftext|>y", "a" * 5_000, " " * 3_000, "ه" * 2_000, "0" * 999, "\r\n\r\n", "<|endof"):
        assert own.encode(text) == public.encode(text, add_special_tokens=False).ids


def test_column(spark):
    df = spark.createDataFrame([(1, None, "i"), (2, "", "j"), (3, " ", "k"), (4, "hello", "l")], "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in encode_column(df, "text", ["doc_id"]).collect()}
    assert got[1] == [] and got[2] == [] and len(got[3]) == 1 and got[4] == [31373]
    assert encode_column(df.limit(0), "text", ["doc_id"]).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=60), st.lists(st.integers(0, 3), min_size=60, max_size=60))
def test_packing_is_whole(sizes, sources):
    rows = pack_sizes(sizes, 32, sources[: len(sizes)], sources[: len(sizes)])
    held = {}
    for b, place, item, piece, start, size in rows:
        held.setdefault(b, []).append((place, size))
        assert start == piece * 32 and (size == 32 or start + size == sizes[item])
    assert sorted((i, sum(s for _, _, j, _, _, s in rows if j == i)) for i in range(len(sizes))) == list(enumerate(sizes))
    for content in held.values():
        assert [p for p, _ in content] == list(range(len(content))) and sum(s for _, s in content) <= 32
    least = -(-sum(sizes) // 32)
    assert len(held) <= max(1, least * 11 // 9 + 6) or not sizes


def test_conflicts_give_way_to_room():
    assert len({r[0] for r in pack_sizes([16, 16], 32, ["a", "a"], ["c", "c"])}) == 1
    assert len({r[0] for r in pack_sizes([16, 16], 32, ["a", "a"], ["c", "c"], strict=True)}) == 2
    apart = {r[2]: r[0] for r in pack_sizes([16, 16, 16, 16], 32, ["a", "a", "b", "b"], None)}
    assert apart[0] != apart[1] and apart[2] != apart[3]


def test_containers(spark):
    rows = [(i, "word " * (i % 7 * 100), "s", "lang") for i in range(60)] + [(100, None, None, None), (101, "", "s", None), (102, "x " * 6_000, "s", None), (None, "a", "b", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard string")
    got = containers(df, shard_rows=25).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows if r[0] is not None}
    load = {}
    for r in got:
        load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
    assert max(load.values()) <= 2048 and sum(1 for r in got if r.doc_id == 102) == 3
    assert containers(df.limit(0)).count() == 0


def test_only_copies_conflict_and_signatures_do_not_decide():
    from silsila.llm.packing import Packer, pack_sizes

    # 200 documents of one, each its own cluster: no two conflict, though signatures have 64 bits
    rows = pack_sizes([10] * 200, 100, clusters=list(range(200)), strict=True)
    assert len({r[0] for r in rows}) == 20
    # two copies never share a bin when the rule is strict
    rows = pack_sizes([10] * 8, 100, clusters=["a"] * 4 + ["b"] * 4, strict=True)
    bins = {}
    for b, _, item, *_ in rows:
        bins.setdefault(b, []).append("ab"[item // 4])
    assert all(len(set(held)) == len(held) for held in bins.values()) and len(bins) == 4
    # keys that share a bit of the signature are told apart
    p = Packer(100, strict=True)
    for i in range(65):
        p.place(1, cluster=i)
    assert len(p.residual) == 1
