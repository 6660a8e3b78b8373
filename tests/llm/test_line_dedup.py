from tabulint.llm.line_dedup import drop_repeated_lines


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = [] if text is None else text.split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p : p + 3])
            if window in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(window)
        out[i] = (None if text is None else "\n".join(x for p, x in enumerate(lines) if p not in gone), len(lines), len(gone))
    return out


def test_equals_brute_force(odd, rows):
    more = [(300, "x\ny\nz\nx\ny\nz\nx\ny\nz"), (301, "x\ny\nz"), (302, "\n\n\n\n"), (303, "y\nz\r\nx")]
    docs = odd.unionByName(odd.sparkSession.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in drop_repeated_lines(docs).collect()}
    assert found == brute(rows + more)
    assert set(odd.columns) <= set(drop_repeated_lines(odd).columns)


def test_empty_table_and_repeated_rows(llm, empty):
    assert drop_repeated_lines(empty).count() == 0
    docs = llm.createDataFrame([(None, "a\nb\nc"), (7, "a\nb\nc"), (8, None), (8, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in drop_repeated_lines(docs).collect()) == [("7", 3), ("8", 0), ("8", 0), ("None", 0)]
