"""op10's signatures: what they are, dart by dart, and what they cost."""

import time

import numpy as np
import pytest

from millrace.llm import op10_dartminhash
from millrace.llm.common import mix

PLACES = op10_dartminhash.PLACES
DARTS = PLACES * op10_dartminhash.DARTS_A_PLACE
STEP = 0x9E3779B97F4A7C15


def texts(words, n, seed):
    r = np.random.default_rng(seed)
    return [" ".join(map(str, r.integers(0, 10**6, words))) for _ in range(n)]


def dart_by_dart(units, until):
    """The signature of one text: each unit's darts, one at a time; None where a place stays empty."""
    best = np.full(PLACES, 2**64 - 1, np.uint64)
    for unit in units:
        at, step = 0.0, 0
        while True:
            step += 1
            g = mix(np.array([(int(unit) + step * STEP) % 2**64], np.uint64))
            at -= np.log((float(g[0] >> np.uint64(11)) + 0.5) * 2.0**-53)
            if at >= until:
                break
            name = int(mix(g ^ np.uint64(STEP))[0])
            dart = int(np.float32(at).view(np.uint32)) << 32 | name >> 32
            best[name % PLACES] = min(int(best[name % PLACES]), dart)
    return None if (best == 2**64 - 1).any() else best


def test_signatures_are_those_of_darts_thrown_one_by_one():
    some = ["", *texts(1, 3, 1), *texts(5, 2, 2), "", *texts(7, 3, 3), *texts(40, 30, 4), *texts(600, 2, 5), "a b " * 90, ""]
    units, owner = op10_dartminhash.elements(some)
    got = op10_dartminhash.signatures(units, owner, len(some))
    doubled = 0
    for i in range(len(some)):
        own = units[owner == i]
        if not len(own):
            assert (got[i] == 2**64 - 1).all()
            continue
        until = DARTS / len(own)
        while (want := dart_by_dart(own, until)) is None:
            doubled += 1
            until *= 2
        assert (got[i] == want).all()
    assert doubled


def test_signatures_do_not_depend_on_the_other_texts():
    some = [*texts(300, 20, 1), *texts(2, 20, 2), *texts(30_000, 1, 3), *texts(60, 20, 4)]
    units, owner = op10_dartminhash.elements(some)
    got = op10_dartminhash.signatures(units, owner, len(some))
    for i in range(0, len(some), 7):
        own = units[owner == i]
        alone = op10_dartminhash.signatures(own, np.zeros(len(own), np.int64), 1)
        assert (got[i] == alone[0]).all()
    mirrored = op10_dartminhash.signatures(units[::-1], len(some) - 1 - owner[::-1], len(some))
    assert (mirrored == got[::-1]).all()


def cpu(run):
    """Least of three runs, in CPU seconds."""
    took = []
    for _ in range(3):
        begin = time.process_time()
        run()
        took.append(time.process_time() - begin)
    return min(took)


def only_hashed(darts):
    """What every dart needs: two hashes, a logarithm and a comparison at its place."""
    best = np.full(PLACES, 2**64 - 1, np.uint64)
    for at in range(0, int(darts), 16_384):
        g = mix(np.arange(at, at + 16_384, dtype=np.uint64))
        np.log(g.astype(np.float64) + 0.5)
        name = mix(g ^ np.uint64(STEP))
        np.minimum.at(best, (name % np.uint64(PLACES)).astype(np.int64), name)


@pytest.mark.parametrize("some", [texts(500, 150, 1), texts(500, 150, 1) + texts(3, 2, 2), texts(3, 60, 3)])
def test_signatures_cost_little_more_than_their_darts(some):
    units, owner = op10_dartminhash.elements(some)
    spent = cpu(lambda: op10_dartminhash.signatures(units, owner, len(some)))
    ratio = spent / cpu(lambda: only_hashed(DARTS * len(some)))
    assert ratio < 6
