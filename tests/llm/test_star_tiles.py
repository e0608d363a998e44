"""Stars of more than one chunk: how many members one comparison holds, and what is linked."""

import random
from collections import Counter

import pytest
from gaugeline.llm import signature_join
from test_operators import groups_of


def passage_corpus():
    """Unlinked texts around one shared passage, and a few near copies."""
    draw = random.Random(4)
    passage = [f"p{i}" for i in range(24)]
    texts = [[*passage, *(f"w{draw.randrange(5000)}" for _ in range(36))] for _ in range(50)]
    texts += [[*texts[i][:-1], "changed"] for i in range(0, 40, 5)]
    return list(enumerate(" ".join(t) for t in texts))


@pytest.mark.parametrize("chunk", [4, 7])
def test_no_group_exceeds_two_chunks(make_docs, monkeypatch, chunk):
    monkeypatch.setattr(signature_join, "CHUNK", chunk)
    monkeypatch.setattr(signature_join, "GROUP_ROWS", 1)
    seen, compared = [], signature_join._compared

    def noted(narrow, members, star, least, schema):
        seen.append(Counter((r.center, r.chunk) for r in members.collect()))
        return compared(narrow, members, star, least, schema)

    monkeypatch.setattr(signature_join, "_compared", noted)
    rows = passage_corpus()
    got = signature_join.similar_documents(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == groups_of(rows)
    # Chunks are dealt by hash and differ in size: twice the mean of two chunks at most here.
    assert len(seen) == 2 and max(seen[1].values()) <= 4 * (chunk + 1)
