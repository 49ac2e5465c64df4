"""Packing: exact round trip, capacities, and the order of the method."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from symgrid.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def known():
    return packing.WordTokens(packing.byte_bpe("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def ids(text, known):
    return np.frombuffer(packing.token_bytes(text, known), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t  '  \x1c.,aZ9é<|endoftext|>"), st.characters(codec="utf-8")), max_size=60))
def test_ids_are_those_of_the_tokenizer(known, tokenizer, text):
    assert ids(text, known) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["\n" * 2_000_000, "a" + " " * 1_000_000 + "b", "\t " * 60_000 + "x"])
def test_long_white_space(known, tokenizer, text):
    assert ids(text, known) == tokenizer.encode(text, add_special_tokens=False).ids


def test_document_of_white_space(spark, docs):
    found = packing.pack_documents(docs([(1, "\n" * 2_000_000), (2, "a b")])).collect()
    assert sum(row.length for row in found if row.doc_id == 1) == next(row.doc_tokens for row in found if row.doc_id == 1)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9000), min_size=1, max_size=40))
def test_pieces_tile_documents_and_sequences(lengths):
    pieces, sizes, _ = packing.pack(lengths)
    by_doc, by_sequence = {}, {}
    for doc, start, length, sequence, offset in pieces:
        by_doc.setdefault(doc, []).append((start, length))
        by_sequence.setdefault(sequence, []).append((offset, length))
    for found, wanted in ((by_doc, dict(enumerate(lengths))), (by_sequence, dict(enumerate(sizes)))):
        assert set(found) == set(wanted)
        for key, parts in found.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at and length > 0
                at += length
            assert at == wanted[key]
    assert all(size == packing.SEQUENCE or size & (size - 1) == 0 for size in sizes)


def test_longest_rest_goes_to_the_cheapest_sequence_with_room():
    pieces, sizes, _ = packing.pack([1500, 1400, 700, 496])
    assert sizes == [2048, 2048]
    assert pieces == [(0, 0, 1500, 0, 0), (1, 0, 1400, 1, 0), (2, 0, 648, 1, 1400), (2, 648, 52, 0, 1500), (3, 0, 496, 0, 1552)]
    assert packing.piece_cost(2) > 2 * packing.piece_cost(1)


def test_query_rows_against_the_tokenizer(spark, docs, tokenizer):
    rows = [(1, "the cat, the hat " * 900), (2, None), (3, ""), (4, "a  b\n\nc"), (4, "a  b\n\nc"), (None, "x")]
    found = packing.pack_documents(docs(rows), buffer_tokens=1000).collect()
    pieces = {}
    for row in found:
        pieces.setdefault((row.doc_id, row.doc_tokens), []).append((row.start, row.length, bytes(row.ids)))
    whole = tokenizer.encode(rows[0][1], add_special_tokens=False).ids + [1]
    parts = sorted(pieces[1, len(whole)])
    assert b"".join(part[2] for part in parts) == np.asarray(whole, "<u4").tobytes()
    assert [p[2] for p in pieces[2, 1]] == [p[2] for p in pieces[3, 1]] == [np.asarray([1], "<u4").tobytes()]
    four = len(tokenizer.encode("a  b\n\nc", add_special_tokens=False).ids) + 1
    assert sum(length for _, length, _ in pieces[4, four]) == 2 * four
    assert sum(len(v) for k, v in pieces.items() if k[0] is None) >= 1
    in_sequence = {}
    for row in found:
        in_sequence.setdefault((row.sequence_id, row.sequence_length), []).append((row.offset, row.length))
    for (_, size), parts in in_sequence.items():
        assert sum(length for _, length in parts) == size


def test_empty_table(docs):
    assert packing.pack_documents(docs([])).collect() == []
