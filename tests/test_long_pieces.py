import random

import numpy as np
import pytest
from test_corpus import corpus

from tokenmill.operators import longpieces
from tokenmill.operators.encode import SPLIT_PATTERN, BpeEncoder
from tokenmill.operators.longpieces import Block, shared_token
from tokenmill.operators.seams import split_units
from tokenmill.operators.splits import split_starts
from tokenmill.plans.corpus import joined_split_tokens, split_tokens

LETTERS = "日本語かな"


def learned(texts, merges):
    """Byte-pair ranks from the commonest pairs of some texts, one merge after the other."""
    ranks = {bytes([b]): b for b in range(256)}
    words = [[bytes([b]) for b in text.encode()] for text in texts]
    for _ in range(merges):
        counts = {}
        for word in words:
            for a, b in zip(word, word[1:]):
                counts[a + b] = counts.get(a + b, 0) + 1
        best = max(sorted(counts), key=counts.get)
        if best in ranks:
            break
        ranks[best] = len(ranks)
        for i, word in enumerate(words):
            out, at = [], 0
            while at < len(word):
                if at + 1 < len(word) and word[at] + word[at + 1] == best:
                    out.append(best)
                    at += 2
                else:
                    out.append(word[at])
                    at += 1
            words[i] = out
    return ranks


def encoding(ranks):
    import tiktoken

    return tiktoken.Encoding("t", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


SAMPLE = ["".join(random.Random(3).choices(LETTERS, k=400))]
RANKS = learned(SAMPLE, 60)
DOUBLING = {bytes([b]): b for b in range(256)} | {b"a" * 2**k: 255 + k for k in range(1, 6)}


@pytest.mark.parametrize("ranks, text", [
    (RANKS, "".join(random.Random(1).choices(LETTERS, k=3000)).encode()),
    (DOUBLING, b"a" * 4001),
    (DOUBLING, b"a" * 1999 + b"b" + b"a" * 1500),
])
def test_blocks_entered_anywhere_give_the_tokens_of_the_rest(ranks, text, monkeypatch):
    monkeypatch.setattr(longpieces, "AHEAD", 300)
    whole = encoding(ranks)._core_bpe.encode_single_piece
    encode = lambda piece: whole(piece) if piece else []
    sizes = np.array([len(p) for p, _ in sorted(ranks.items(), key=lambda x: x[1])])
    cuts = [0, 900, 1700, 2600, len(text)]
    for entry in range(int(sizes.max())):
        ids, at = [], entry
        for start, end in zip(cuts, cuts[1:]):
            block = Block(text[start:end], text[end : end + 300], encode, sizes)
            ids += block.tokens(at)
            if end < len(text):
                at = block.leave(at)
        assert ids == encode(text[entry:])


def test_shared_token():
    assert shared_token(np.array([0, 2, 5, 7]), np.array([1, 2, 4, 5, 7, 9])) == (2, 3)
    assert shared_token(np.array([0, 2, 4]), np.array([1, 3, 5])) is None


def joined_tokens(df, ranks, block):
    found = {}
    encoder = BpeEncoder(dict(ranks))
    rows = joined_split_tokens(df, *split_starts(df, "doc_id", 0.8, 0.15), encoder, block).collect()
    for r in sorted(rows, key=lambda r: r["seq"]):
        assert r["n_tokens"] == len(r["tokens"])
        found.setdefault(r["split"], []).extend(r["tokens"])
    return found, rows


def expected(texts, ranks):
    n = len(texts)
    first, second = int(0.8 * n), int(0.8 * n) + int(0.15 * n)
    cuts = {"train_set": texts[:first], "val_set": texts[first:second], "test_set": texts[second:]}
    ids = lambda t: [len(ranks), *encoding(ranks).encode_ordinary("".join(t))]
    return {split: ids(own) for split, own in cuts.items()}


def test_texts_without_white_space_are_cut_into_bounded_units(spark):
    draws = random.Random(5)
    texts = ["".join(draws.choices(LETTERS, k=11)) for _ in range(2000)]
    df = corpus(spark, texts)
    units = split_units(df, *split_starts(df, "doc_id", 0.8, 0.15), 1000).collect()
    assert max(len(u.text.encode()) for u in units) < 2100
    assert sum(u.soft_start for u in units) > 40
    found, rows = joined_tokens(df, RANKS, 1000)
    assert found == expected(texts, RANKS)
    assert max(r["n_tokens"] for r in rows) < 1500


def test_maps_that_remember_their_entry(spark):
    texts = ["a" * 37] * 300 + ["b"] + ["a" * 23] * 100
    found, rows = joined_tokens(corpus(spark, texts), DOUBLING, 500)
    assert found == expected(texts, DOUBLING)
    assert len(rows) > 15


@pytest.mark.parametrize("seed, block", [(0, 40), (1, 64), (2, 300), (3, 100)])
def test_mixed_texts(spark, seed, block):
    """Letters, digits, marks, contractions and white space in any order, on soft borders and off."""
    draws = random.Random(seed)
    words = ["日本語" * 4, "の", "12345678901", "1", "!!!???----", "'", "s", "'s", " ", "  ", "\n", "don't",
             "the", "é", "☃☃☃☃☃", "", " ", "ll", "。", "a" * 30]
    texts = []
    for _ in range(400):
        kind = draws.choice(words)
        texts += [kind] * draws.randrange(1, 12) if draws.random() < 0.3 else [
            "".join(draws.choices(words, k=draws.randrange(4)))
        ]
    ranks = RANKS | {b"th": len(RANKS), b"the": len(RANKS) + 1, b" t": len(RANKS) + 2,
                     b"aa": len(RANKS) + 3, b"11": len(RANKS) + 4, b"!!": len(RANKS) + 5,
                     b"'s": len(RANKS) + 6}
    found, _ = joined_tokens(corpus(spark, texts), ranks, block)
    assert found == expected(texts, ranks)


def test_other_patterns_are_refused(spark):
    with pytest.raises(ValueError, match="published pattern"):
        split_tokens(corpus(spark, ["a"]), encoder=BpeEncoder(dict(RANKS), r"\S+|\s+"))
