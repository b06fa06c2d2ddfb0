import random
import tracemalloc

import numpy as np
import pyarrow as pa

from clickscope.llm import substrings as S


def bucket(texts):
    return S.Bucket(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()),
                              "text": pa.array([t.encode() for t in texts], pa.binary())}))


def test_contexts_take_little_more_than_their_bytes():
    rnd = random.Random(2)
    some = bucket(["".join(rnd.choice("abcd") for _ in range(200_000))])
    places = np.arange(0, 199_000, 4)
    tracemalloc.start()
    got = some.contexts(places)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got["which"]) == len(places)
    assert peak < 8 * S.WIDTH * len(places)


def test_contexts_are_the_same_in_small_steps(monkeypatch):
    rnd = random.Random(3)
    text = "".join(rnd.choice("ab") for _ in range(400))
    some = bucket([text, text[100:], "short", "", text[:90] + text])
    places = np.arange(0, len(some.data) - S.GRAM, 3)
    places = places[places + S.GRAM <= some.ends[some.holder(places)]]
    want = some.contexts(places)
    monkeypatch.setattr(S, "STEP", 7)
    got = some.contexts(places)
    assert want.keys() == got.keys() and all((want[k] == got[k]).all() for k in want)
    for which, doc, begin in zip(got["which"], got["doc"], got["begin"]):
        lo, hi = got["bounds"][which]
        assert some.starts[doc] <= begin + lo and begin + hi <= some.ends[doc]
        assert (got["rows"][which][lo:hi] == some.data[begin + lo:begin + hi]).all()
        assert not got["rows"][which][:lo].any() and not got["rows"][which][hi:].any()
