"""Greedy string tiling by running Karp-Rabin against a search of every length."""

import random
import time

import pytest

from tessera.llm.op10_tiling import BenchmarkBlock, greedy_tiles


def plain(item, runs, least):
    """Lengths go down one by one; the first free match by run, its place and the item's place is marked."""
    free, open_runs, tiles = [True] * len(item), [[True] * len(r) for r in runs], []
    for n in range(min(len(item), max(map(len, runs), default=0)), least - 1, -1):
        for r, run in enumerate(runs):
            for j in range(len(run) - n + 1):
                for i in range(len(item) - n + 1):
                    if item[i:i + n] == run[j:j + n] and all(free[i:i + n]) and all(open_runs[r][j:j + n]):
                        free[i:i + n] = open_runs[r][j:j + n] = [False] * n
                        tiles.append((i, r, j, n))
    return tiles


@pytest.mark.parametrize("seed", range(60))
def test_same_tiles_as_a_search_of_every_length(seed):
    rng = random.Random(seed)
    letters = rng.choice((1, 2, 3, 8, 50))
    item = [rng.randrange(letters) + 1 for _ in range(rng.randint(1, 40))]
    runs = []
    for _ in range(rng.randint(1, 4)):
        cut = rng.randrange(len(item))
        runs.append(rng.choice((item[cut:] + item[:cut], [rng.randrange(letters) + 1 for _ in range(rng.randint(1, 30))], item[:cut] + [9] + item[cut:])))
    least = rng.choice((1, 2, 5))
    assert greedy_tiles(item, runs, least) == plain(item, runs, least)


def test_no_runs():
    assert greedy_tiles([1, 2, 3], [], 1) == [] and greedy_tiles([], [[1]], 1) == []


@pytest.mark.parametrize("words", [2000, 20_000])
def test_long_items(words):
    """A long item, cut up and shuffled, is covered but for what is shorter than a seed, in seconds."""
    rng = random.Random(words)
    item = [f"w{rng.randrange(5000)}" for _ in range(words)]
    pieces = [item[s:s + 40] for s in range(0, words, 40)]
    rng.shuffle(pieces)
    text = " ".join(w for p in pieces for w in p)
    block = BenchmarkBlock([(1, " ".join(item)), (2, "another item of seven words in all")])
    began = time.perf_counter()
    (found,) = block.matches([text])
    assert found[1] == 1 and found[3] == words and found[4] <= len(pieces)
    assert time.perf_counter() - began < 20
    assert block.contaminated([" ".join(item[:words // 2])]) == []


@pytest.mark.parametrize("seed", range(5))
def test_random_texts_against_plain_coverage(seed):
    rng = random.Random(seed)
    items = [[f"w{rng.randrange(30)}" for _ in range(rng.randint(5, 60))] for _ in range(6)]
    texts = []
    for _ in range(20):
        own = rng.choice(items)
        cut = rng.randrange(len(own))
        noise = [f"x{rng.randrange(9)}" for _ in range(rng.randint(0, 10))]
        texts.append(rng.choice((own[cut:] + noise + own[:cut], own, noise, own[:cut], noise + own + noise)))
    block = BenchmarkBlock([(k, " ".join(i)) for k, i in enumerate(items)])
    got = {(m[0], m[1]): m[3] for m in block.matches([" ".join(t) for t in texts])}
    for d, text in enumerate(texts):
        for k, item in enumerate(items):
            covered = sum(t[3] for t in plain(item, [text], 5)) if text else 0
            assert got.get((d, k), 0) == covered
