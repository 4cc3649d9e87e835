import random

from kpiloom.llm.line_dedup import REMOVED, dedup_lines


def solid(text):
    return [(i, x.strip(" \t\r\f\v")) for i, x in enumerate((text or "").split("\n")) if x.strip(" \t\r\f\v")]


def run(docs):
    return {(r.doc_id, r.text_was): (r.text, list(r[REMOVED])) for r in
            dedup_lines(docs.withColumn("text_was", docs["text"])).collect()}


def check(rows, got):
    pairs, runs, lines = set(), set(), set()
    for d, t in sorted({r for r in rows}, key=lambda r: (r[0] is not None, r[0])):
        text, gone = got[(d, t)]
        own = solid(t)
        allowed = set()
        for (i, a), (j, b) in zip(own, own[1:]):
            if (a, b) in pairs:
                allowed |= {i, j}
            pairs.add((a, b))
        assert set(gone) <= allowed                              # only lines of runs that came before
        for k in range(len(own) - 2):
            three = tuple(x for _, x in own[k:k + 3])
            if three in runs:
                assert {i for i, _ in own[k:k + 3]} & set(gone)  # every run of three is found
            runs.add(three)
        kept = [x for i, x in enumerate((t or "").split("\n")) if i not in gone]
        assert text == (None if t is None else "\n".join(kept))
        lines |= {x for i, x in own if i not in gone}
        assert {x for _, x in own} <= lines                      # each line stays somewhere before or here


def test_runs_against_brute_force(make_docs, prose, hard_rows):
    r = random.Random(3)
    pool = [f"line {i} " + prose(i, 4) for i in range(60)]
    rows = [x for x in hard_rows if x[0] != 1 and x[0] != 2]
    for d in range(40):
        own = r.sample(pool, 5) + [f"own {d} {k}" for k in range(4)]
        r.shuffle(own)
        at = r.randrange(50)
        rows.append((50 + d, "\n".join(own[:4] + pool[at:at + r.randint(1, 8)] + ["", *own[4:]])))
    rows.append((500, "\n".join(["same"] * 50)))                 # repeats inside one text
    check(rows, run(make_docs(rows)))


def test_first_copy_stays_and_extension_covers_the_run(make_docs):
    run_ = [f"l{i}" for i in range(9)]
    a, b = "\n".join(["a", *run_, "z"]), "\n".join(["b", *run_, "y"])
    got = run(make_docs([(2, b), (1, a)]))
    assert got[(1, a)] == (a, [])
    assert got[(2, b)] == ("b\ny", list(range(1, 10)))


def test_every_line_of_a_repeated_run_goes(make_docs):
    r = random.Random(6)
    rows, whole = [], []
    for g in range(40):                                          # pairs of the run come before in other surroundings
        names = [f"{g} {r.random()}" for _ in range(r.randint(3, 6))]
        rows += [(1000 * g + k, f"before {g} {k}\n{a}\n{b}\nafter {g} {k}") for k, (a, b) in enumerate(zip(names, names[1:]))]
        rows += [(1000 * g + k, "\n".join([f"own {g} {k}", *names, f"last {g} {k}"])) for k in (100, 101)]
        whole.append((rows[-1], list(range(1, len(names) + 1))))
    for g in range(40):                                          # the middle line alone, with other neighbours, comes before
        a, b, c, d = (f"{g} x {r.random()}" for _ in range(4))
        rows += [(50_000 + 10 * g, f"{b}\n{c}"), (50_001 + 10 * g, f"{a}\n{b}\n{c}\n{d}"), (50_002 + 10 * g, f"{a}\n{b}\n{c}\n{d}")]
        whole.append((rows[-1], [0, 1, 2, 3]))
    got = run(make_docs(rows))
    assert all(got[row][1] == gone for row, gone in whole)


def test_long_passages_on_one_or_two_lines_go(make_docs):
    def line(name, n):
        return " ".join(f"{name}w{k}" for k in range(n))
    rows, want = [], {}
    for g in range(30):
        one, short, long_ = line(f"a{g}", 50), line(f"b{g}", 24), line(f"c{g}", 26)
        pair = f"{short}\n{long_}" if g % 2 else f"{long_}\n{short}"
        rows += [(10 * g, f"p{g}\n{one}\nq{g}"), (10 * g + 1, one), (10 * g + 2, f"r{g}\n  {one} \n\ns{g}"),
                 (10 * g + 3, f"{pair}\nt{g}"), (10 * g + 4, f"u{g}\n{pair}"), (10 * g + 5, pair)]
        want |= {10 * g: [], 10 * g + 1: [0], 10 * g + 2: [1], 10 * g + 3: [], 10 * g + 4: [1, 2], 10 * g + 5: [0, 1]}
        rows += [(10 * g + 6, line(f"d{g}", 24)), (10 * g + 7, "  \t" + line(f"d{g}", 24).replace(" ", "  "))]     # not long
        want |= {10 * g + 6: [], 10 * g + 7: []}
    assert {d: gone for (d, _), (_, gone) in run(make_docs(rows)).items()} == want


def test_equal_rows_are_one_document(make_docs):
    t = "one\ntwo\nthree"
    out = dedup_lines(make_docs([(1, t), (1, t), (2, t)])).collect()
    assert sorted((r.doc_id, r.text) for r in out) == [(1, t), (1, t), (2, "")]


def test_native_and_empty(make_docs):
    df = dedup_lines(make_docs([]))
    assert df.count() == 0
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_blank_lines_of_any_white_space_stay_and_crlf_matches_lf(make_docs, prose):
    tabs = "gamma\n\t\n\t\ndelta"
    run3 = [f"line {k} " + prose(70 + k, 5) for k in range(3)]
    rows = [(1, "alpha\n\t\n\t\nbeta"), (2, tabs), (3, "\n".join(["one", *run3])), (4, "\r\n".join(["two", *run3, "three"]))]
    got = run(make_docs(rows))
    assert got[(2, tabs)] == (tabs, [])
    assert got[(4, rows[3][1])] == ("two\r\nthree", [1, 2, 3])
