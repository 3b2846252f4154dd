import random

from lakekpi.llm import near_dups as nd

from .conftest import frame, prose


def brute(rows, width, percent=80):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for x in range(len(rows)):
        if rows[x][0] is not None:
            least[find(x)] = min(least.get(find(x), rows[x][0]), rows[x][0])
    return sorted(((i, len(s), None if i is None else least[find(x)], i == (None if i is None else least[find(x)]))
                   for x, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def test_equals_brute_force(llm, awkward):
    for width in (2, 5):
        got = nd.near_duplicates(frame(llm, awkward), shingle_words=width)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
        assert sorted(map(tuple, got.collect()), key=str) == brute(awkward, width)


def test_rounds_and_chunks_lose_nothing(llm, awkward, monkeypatch):
    rows = [r for r in awkward if r[0] is not None and 20 <= r[0] < 60]
    for rounds, chunk in ((0, 1000), (3, 4)):  # no rounds of closest partners, and several with tiny chunks
        monkeypatch.setattr(nd, "ROUNDS", rounds)
        monkeypatch.setattr(nd, "CHUNK", chunk)
        monkeypatch.setattr(nd, "BLOCK", chunk)
        assert sorted(map(tuple, nd.near_duplicates(frame(llm, rows), shingle_words=2).collect()), key=str) == brute(rows, 2)


def test_empty_table(llm):
    assert nd.near_duplicates(frame(llm, [])).collect() == []
    assert [tuple(r) for r in nd.near_duplicates(frame(llm, [(3, None)])).collect()] == [(3, 0, 3, True)]


def test_unlike_rows_of_one_id_keep_their_links(llm):
    rng = random.Random(3)
    a, b = prose(rng, 80, 5000), prose(rng, 80, 5000)
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (4, prose(rng, 50)), (1, a), (None, a)]
    assert sorted(map(tuple, nd.near_duplicates(frame(llm, rows), shingle_words=2).collect()), key=str) == brute(rows, 2)
    kept = nd.drop_near_duplicates(frame(llm, rows), shingle_words=2)
    assert kept.columns == frame(llm, rows).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (1, b), (4, rows[4][1]), (None, a)], key=str)
    # a text whose namesake goes with another group stays
    rows = [(5, a), (5, b), (2, a + " z")]
    assert sorted((r.doc_id, r.text) for r in nd.drop_near_duplicates(frame(llm, rows), shingle_words=2).collect()) == sorted([(2, a + " z"), (5, b)])
