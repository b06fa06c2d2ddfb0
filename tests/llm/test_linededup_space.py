import re

from clickscope.llm import linededup as L


def folded(line):
    """The normal form, without the module's."""
    return re.sub(r"\s+", " ", line).strip().lower()


def test_lines_that_differ_in_inner_white_space_fold(make_docs):
    lines = ["A line.", "a  line.", " a\tLINE. ", "b  1  2\t3", "B 1 2 3", "a lime", "ab"]
    got = L.deduplicated_lines(make_docs(list(enumerate(lines)))).collect()
    first = {}
    for i, line in enumerate(lines):
        first.setdefault(folded(line), i)
    assert {r.doc_id: r.n_removed for r in got} == {i: int(first[folded(x)] != i) for i, x in enumerate(lines)}
