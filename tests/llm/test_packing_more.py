"""Packing against all packings of few pieces, and with other tokenizers."""

import itertools
import random

import numpy as np
import pytest

pytest.importorskip("lodestar.llm.queries")

from lodestar.llm import packing  # noqa: E402


def fewest(lengths, cap):
    """Fewest sequences by trying every assignment."""
    best = len(lengths)

    def place(k, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if k == len(lengths):
            best = len(fills)
            return
        seen = set()
        for b, f in enumerate(fills):
            if f + lengths[k] <= cap and f not in seen:
                seen.add(f)
                place(k + 1, fills[:b] + [f + lengths[k]] + fills[b + 1:])
        place(k + 1, fills + [lengths[k]])

    place(0, [])
    return best


def test_small_groups_near_the_best():
    rng, over, gained = random.Random(3), 0, 0
    for _ in range(150):
        lengths = np.array([rng.randint(1, 12) for _ in range(rng.randint(1, 9))] if rng.random() < 0.5
                           else [rng.randint(4, 9) for _ in range(rng.randint(6, 9))])
        bins = packing.pack_group(lengths, 12)
        assert sorted(itertools.chain(*bins)) == list(range(len(lengths)))
        assert all(lengths[b].sum() <= 12 for b in bins)
        start = packing.best_fit(lengths, 12)
        best = fewest(sorted(lengths.tolist(), reverse=True), 12)
        assert best <= len(bins) <= len(start)
        over += len(bins) - best
        gained += len(start) - len(bins)
    assert over <= 3


def no_step_is_left(lengths, bins, cap):
    fill = [int(lengths[b].sum()) for b in bins]
    for a, b in itertools.permutations(range(len(bins)), 2):
        if fill[a] >= cap or fill[b] >= cap:
            continue
        gifts = [[i] for i in bins[a]] + [list(x) for x in itertools.combinations(bins[a], 2)]
        for give in gifts:
            s = int(lengths[give].sum())
            takes = [[j] for j in bins[b]] + ([[]] if len(give) == 1 else [])
            for take in takes:
                got = s - int(lengths[take].sum()) if take else s
                if got > 0 and fill[b] + got <= cap and fill[b] + got > fill[a]:
                    return False
    return True


def test_search_ends_where_no_step_helps():
    rng = random.Random(8)
    for _ in range(40):
        lengths = np.array([rng.randint(5, 60) for _ in range(40)])
        assert no_step_is_left(lengths, packing.pack_group(lengths, 100), 100)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_files_own(name):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    spec = packing.read_tokenizer(P.path(name))
    cache, whole = packing.TokenCache(spec), Tokenizer.from_str(spec)
    assert cache.by_units == (name == "word_bpe_49k.json")
    for t in ["", " ", "Hello World, it's 2024  ok", "ÉCOLE\n\tl'été  ß İ", "日本 <|endoftext|> x", "a" * 5000]:
        assert np.frombuffer(cache.encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t
