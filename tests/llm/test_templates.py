from spokewise.llm import templates as L


def run(docs, **options):
    return {r.doc_id: r for r in L.drop_recurring_lines(docs, **options).collect()}


def test_fields_are_generalised_and_recurring_templates_go(documents):
    names = ["Ann", "Bob", "Cy", "Dee", "Eve", "Flo", "Gus", "Hal"]
    rows = [f"own text number {k} stays here because it is long {'abcdefgh'[k]} words {k}\nPosted by {n} on 2024-01-0{k} at noon\nshort line" for k, n in enumerate(names)]
    rows = [r.replace("own text number", f"own{'abcdefgh'[k]} text{k}x of this") for k, r in enumerate(rows)]
    found = run(documents(rows), least_documents=4)
    for k in range(8):
        assert found[k].n_lines == 3 and found[k].n_dropped == 1
        assert found[k].text == "\n".join(rows[k].split("\n")[::2])


def test_unlike_lines_of_one_leaf_stay(documents):
    rows = [f"the same start {'abcdefghij'[k]}{'k' * k} {'zyxwvutsrq'[k]}{'m' * k} {'o' * (k + 1)} {'p' * (k + 1)}" for k in range(10)]
    assert all(r.n_dropped == 0 for r in run(documents(rows), least_documents=4).values())


def test_counts_documents_not_lines(documents):
    line = "this very line is repeated often"
    rows = ["\n".join([line] * 20), "nothing else is in here", line + "\nnothing else is in here"]
    assert all(r.n_dropped == 0 for r in run(documents(rows), least_documents=3).values())
    found = run(documents(rows), least_documents=2)
    assert [found[k].n_dropped for k in range(3)] == [20, 1, 2] and found[0].text == ""


def test_odd_rows(documents):
    line = "this very line is repeated often"
    rows = [(1, None), (2, ""), (3, line), (4, "  " + line + " "), (None, line), (5, "a b c"), (6, "a b c"), (7, "a b c"), (8, line), (8, line)]
    docs = documents(rows).withColumnRenamed("lang", "masked").withColumnRenamed("source", "gone2")
    found = L.drop_recurring_lines(docs, least_documents=3)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows)
    assert got[1].text is None and got[1].n_lines == 0 and got[2].text == "" and got[2].n_lines == 1
    assert got[3].text == got[4].text == got[None].text == got[8].text == ""
    assert got[5].n_dropped == 0
    assert L.drop_recurring_lines(docs.limit(0)).count() == 0


def test_very_long_lines(documents):
    long = "word " * 100_000 + "end"
    found = run(documents([long, long, long, "other " * 5]), least_documents=3)
    assert [found[k].n_dropped for k in range(4)] == [1, 1, 1, 0]


def test_lines_are_unfolded_twice_and_masked_once_each(documents, monkeypatch):
    """The places of lines to drop come from the lines already found; neither texts nor masks are worked out again."""
    passes, masks = [], []
    unfolded, masked = L._unfolded, L.masked_line
    monkeypatch.setattr(L, "_unfolded", lambda *a: passes.append(a) or unfolded(*a))
    monkeypatch.setattr(L, "masked_line", lambda line: masks.append(line) or masked(line))
    rows = [f"Posted by us on day {k}\n{'abc'[k]} line of its own\nx\n Posted by us on day {k}{k} \n" for k in range(3)]
    docs = documents(rows + rows[:1])
    found = L.drop_recurring_lines(docs, least_documents=4)
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in found.collect()}
    assert len(passes) == len(masks) == 2
    for k in range(4):
        lines = (rows + rows[:1])[k].split("\n")
        assert got[k] == ("\n".join([lines[1], "x", ""]), 5, 2)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "transform(__parts" not in text and "transform(array_except(" in text and "[0-9]" not in text
    kept = L.recurring_lines(docs, least_documents=4)
    assert kept.columns == ["masked", "template", "documents"] and {(r.masked, r.documents) for r in kept.collect()} == {("Posted by us on day <*>", 4)}
