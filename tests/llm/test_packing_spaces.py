"""Ids of texts with white space of several kinds against the tokenizers library."""

import itertools

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronofeat.llm.packing import ByteBpe

BYTE = public_tokenizers.path("byte_bpe_50k.json")
LIB, OWN = Tokenizer.from_file(BYTE), ByteBpe(BYTE)


def same(texts):
    assert [x.tolist() for x in OWN.encode(texts)] == [LIB.encode(t, add_special_tokens=False).ids for t in texts]


def test_spaces_inside_tokens():
    assert [x.tolist() for x in OWN.encode(["a \xa0 \xa0 b"])] == [[64, 11504, 275]]
    kinds = ["\xa0", "\t", "　", "\n", " ", " "]
    runs = ["".join(r) for n in (1, 2, 3, 4) for r in itertools.product(kinds[:4] + [" "], repeat=n)]
    same([f"a{r}b c" for r in runs] + [f"a b{r}" for r in runs] + [f"{r}a b" for r in runs])
    same([f"x y{k}" for k in kinds])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=" \xa0\t　\n\x85\x1cab'", max_size=30), min_size=1, max_size=4))
def test_any_white_space(texts):
    same(texts)
