import random

import numpy as np

from clickscope.llm import pieces as P

from .test_pieces import TABLE


def test_chunks_of_a_batch_are_met_together(monkeypatch):
    """No chunk of a batch is segmented by itself, also when the store is full."""
    with open(P.MODEL, "rb") as f:
        pieces = P.Pieces(f.read())
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9)))
    texts = [" ".join(word() for _ in range(60)) for _ in range(40)]
    monkeypatch.setattr(P, "CACHE", 500)
    monkeypatch.setattr(pieces, "forward", None)  # of a chunk by itself
    for at in (0, 10, 5, 20, 0, 30):
        batch = texts[at:at + 10]
        chunks = [P.CHUNK.findall(" " + t) for t in batch]
        met = pieces.meet(chunks)
        spelled = pieces.spell(met.ids, met.id_ends[met.chunk_ends[1:]])
        assert [x[1:].decode() for x in spelled] == batch
        assert len(pieces.store.count) <= 500 + sum(map(len, chunks))
        for i, t in enumerate(batch):
            a, b = met.chunk_ends[i:i + 2]
            ids, scores, _ = TABLE.encode(t)
            assert (met.ids[met.id_ends[a]:met.id_ends[b]] == ids).all()
            assert np.isclose(sum(met.scores[a:b]), scores[0])
