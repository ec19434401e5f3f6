"""Line dedup against brute force over all pairs of places."""

import random

from corpus_fixtures import edge_pairs, make_docs  # noqa: F401

from tracecurate.llm import lines


def brute_runs(pairs, m, words=25):
    """What ``dedup_runs`` returns, from the longest earlier copy of every suffix."""
    docs = sorted({(i is not None, i or 0, t) for i, t in pairs if t is not None}, key=lambda d: (d[0], d[1], 0))
    split = [[(k, x) for k, x in enumerate(t.split("\n")) if x.strip(" \t\r")] for _, _, t in docs]
    bare = [[x.strip(" \t\r") for _, x in own] for own in split]
    out, places = {}, {}
    for d, (known, i, t) in enumerate(docs):
        lengths = []
        for p, line in enumerate(bare[d]):
            best = 0
            for e, q in places.get(line, []):
                n = 0
                while p + n < len(bare[d]) and q + n < len(bare[e]) and bare[d][p + n] == bare[e][q + n]:
                    n += 1
                best = max(best, n)
            lengths.append(best)
            places.setdefault(line, []).append((d, p))
        starts = [(p, n) for p, n in enumerate(lengths) if n and not (p and lengths[p - 1] == n + 1)]
        wordy = [any(len(x.split()) >= words for x in bare[d][p : p + n]) for p, n in starts]
        gone = {p + k for (p, n), w in zip(starts, wordy) if n >= m or w or (p == 0 and n == len(bare[d])) for k in range(n)}
        numbers = {split[d][p][0] for p in gone}
        kept = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in numbers)
        out[(i if known else None, t)] = (kept, len(bare[d]), len(gone), sum(p - 1 not in gone for p in gone), max(lengths, default=0))
    return sorted(((i, *(out[i, t] if t is not None else (None, 0, 0, 0, 0))) for i, t in pairs), key=repr)


def our_runs(docs, m, words=25):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_removed, r.n_runs, r.longest_run) for r in lines.dedup_runs(docs, m, words).collect()), key=repr)


def test_runs_equal_brute_force(make_docs, edge_pairs):
    rng = random.Random(5)
    pool = [f"line {k}" for k in range(4)] + ["", " "]
    base = [f"base {k}" for k in range(40)]
    pairs = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(25)))) for k in range(30)]
    for k in range(30):
        start = rng.randrange(30)
        pairs.append((50 + k, "\n".join([f"own {k}", *base[start : start + rng.randrange(20)], f"end {k}"])))
    pairs += [*edge_pairs, (200, "\n".join(["same"] * 70)), (201, "line 1"), (202, "base 3\nbase 4")]
    docs = make_docs(pairs)
    for m in (2, 5):
        assert our_runs(docs, m) == brute_runs(pairs, m)


def test_runs_have_their_exact_length_and_single_lines_stay(make_docs):
    seven = "\n".join(f"x{k}" for k in range(7))
    docs = make_docs([(1, f"a\n{seven}\nb"), (2, f"c\n{seven}\nd"), (3, "e\nx3\nf"), (4, "x3")])
    assert our_runs(docs, 3) == [(1, f"a\n{seven}\nb", 9, 0, 0, 0), (2, "c\nd", 9, 7, 1, 7), (3, "e\nx3\nf", 3, 0, 0, 1), (4, "", 1, 1, 1, 1)]
    assert lines.dedup_runs(make_docs([]), 3).collect() == []


def test_runs_with_a_long_line_go(make_docs):
    rng = random.Random(9)
    pool = [" ".join(f"w{k}{j}" for j in range(rng.randrange(1, 8))) for k in range(6)] + ["a\tb  c d e"]
    pairs = [(k, "\n".join(rng.choice(pool) + rng.choice(["", f" own {rng.random()}"]) for _ in range(rng.randrange(12)))) for k in range(60)]
    for words in (4, 6):
        assert our_runs(make_docs(pairs), 4, words) == brute_runs(pairs, 4, words)


def test_edges(make_docs, edge_pairs):
    long = "\n".join(f"x{k}" for k in range(3000))
    pairs = [*edge_pairs, (20, "\n".join(["same"] * 70)), (21, long + "\n" + long)]
    assert our_runs(make_docs(pairs), 3) == brute_runs(pairs, 3)
    assert our_runs(make_docs([(1, "a"), (2, "b")]), 4) == [(1, "a", 1, 0, 0, 0), (2, "b", 1, 0, 0, 0)]


def test_removal_keeps_columns_and_drops_what_is_used_up(make_docs):
    docs = make_docs([(1, "a\nb\nx"), (2, "b\nc"), (3, "a\nb\nx"), (4, ""), (5, None), (6, "y\na\nb\nx")])
    kept = lines.remove_repeated_lines(docs)
    assert kept.columns == docs.columns
    rows = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert rows == {1: ("a\nb\nx", 5), 2: ("b\nc", 3), 4: ("", 0), 5: (None, None), 6: ("y", 1)}


def test_no_python_on_the_way(make_docs):
    plan = lines.dedup_runs(make_docs([(1, "a"), (2, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
