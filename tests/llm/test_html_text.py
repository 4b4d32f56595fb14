import random
import re
import time

from fairwake.llm.html_text import CLOSES_P, IMPLIED, SCOPES, THROUGH_SCOPES, extract_text, tree, visible_text


def test_blocks_and_implied_tags():
    assert visible_text("<p>one<p>two  <b>bold</b>\n text<br>next") == "one\n\ntwo bold text\nnext"


def test_lists():
    assert visible_text("<ul><li>a<li>b</ul>").splitlines() == ["- a", "- b"]
    assert visible_text("<ol><li>a<li>b</ol>").splitlines() == ["1. a", "2. b"]


def test_invisible_parts():
    html = '<title>t</title><script>x("<p>no</p>")</script><p hidden>h</p><p style="display: none">n</p><!-- c --><p>yes'
    assert visible_text(html) == "yes"


def test_cells_of_a_column_start_at_one_place():
    lines = visible_text("<table><tr><td>a<td>long cell<tr><td>longer<td>b</table>").splitlines()
    assert lines[0].index("long cell") == lines[1].index("b")


def test_odd_inputs():
    assert visible_text("") == "" and visible_text("a &amp; b &lt;") == "a & b <"
    assert visible_text("<pre>a\n  b</pre>") == "a\n  b"
    assert visible_text("</div></p>x<unclosed") .startswith("x")
    assert visible_text("<div>" * 20000 + "deep") == "deep"


def test_spans_of_cells():
    html = "<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>"
    assert visible_text(html).splitlines() == ["A  B", "   C", "D  E"]
    html = "<table><tr><td rowspan=3 colspan=2>A<td>B<tr><td>C<tr><td>D<tr><td>e<td>f<td>g</table>"
    assert visible_text(html).splitlines() == ["A     B", "      C", "      D", "e  f  g"]


def test_wide_characters_take_two_places():
    lines = visible_text("<table><tr><td>\u8a9e\u8a9e<td>x<tr><td>abcd<td>y</table>").splitlines()
    assert lines == ["\u8a9e\u8a9e  x", "abcd  y"]


def test_visible_again():
    hidden = '<div style="visibility: hidden">no <b style="color:red; visibility:visible">yes</b> no<br>no</div>after'
    assert visible_text(hidden) == "yes\nafter"
    assert visible_text('<div style="display:none">no <b style="visibility:visible">no</b></div>x') == "x"


def test_numbers_of_items():
    assert visible_text("<ol start=3><li>a<li value=7>b<li>c</ol>").splitlines() == ["3. a", "7. b", "8. c"]


def test_unclosed_tags_and_quotes_are_text():
    assert visible_text("a <b c 'd> <i>e</i>' \" f") == "a <b c 'd> e' \" f"
    assert visible_text("x <y 'z <b>t</b>") == "x <y 'z t"
    assert visible_text("<p title='a > b'>q</p>") == "q"


def walked(html):
    """What the tree builder keeps open, found by walking the whole stack for every tag."""
    stack, out = [], []

    def close(names, barriers):
        lowest = None
        for i in reversed(range(len(stack))):
            if stack[i] in barriers:
                break
            lowest = i if stack[i] in names else lowest
        if lowest is not None:
            del stack[lowest:]

    for end, name in re.findall(r"<(/?)(\w+)>", html):
        if end:
            for i in reversed(range(len(stack))):
                if stack[i] == name:
                    del stack[i:]
                    break
                if stack[i] in SCOPES and name not in SCOPES | THROUGH_SCOPES:
                    break
        else:
            if name in CLOSES_P:
                close({"p"}, {"table", "td", "th", "button"})
            if name in IMPLIED:
                close(*IMPLIED[name])
            stack.append(name)
        out.append("/".join(stack))
    return out


def test_open_elements_against_walking_the_stack():
    rng = random.Random(6)
    names = "p div table tr td th ul li ol dl dt dd b select option button tbody body".split()
    for _ in range(300):
        tags = [f"<{rng.choice(['', '', '/'])}{rng.choice(names)}>" for _ in range(rng.randint(1, 40))]
        paths, opened = {}, 0
        todo = [(tree("".join(f"{t}{i}." for i, t in enumerate(tags))), "")]
        while todo:
            node, path = todo.pop()
            for child in node.children:
                if isinstance(child, str):
                    for mark in re.findall(r"\d+", child):
                        paths[int(mark)] = path
                else:
                    todo.append((child, f"{path}/{child.name}".lstrip("/")))
        assert [paths[i] for i in range(len(tags))] == walked("".join(tags))


def test_time_grows_with_the_page():
    for html in ("<div>", "<a ", "<a '", "<a \"<b '", "<p><b><i></x>", "<table><tr><td><b></x>", "<li><dd>"):
        start = time.process_time()
        tree(html * 60_000)
        assert time.process_time() - start < 10, html
    start = time.process_time()
    visible_text("<b>" * 60_000 + "</x>" * 60_000 + "<a " * 60_000)
    assert time.process_time() - start < 10


def test_rows(spark):
    rows = [(1, "<p>a", None), (1, "<p>a", "z"), (2, None, "z"), (3, "", "z"), (None, "<p>" + "w " * 100000, "z")]
    table = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract_text(table)
    assert got.columns[:3] == table.columns
    found = sorted(((r[0], r[3]) for r in got.collect()), key=lambda r: str(r)[:40])
    want = [(1, "a"), (1, "a"), (2, None), (3, ""), (None, ("w " * 100000).strip())]
    assert found == sorted(want, key=lambda r: str(r)[:40])
    assert extract_text(table.where("false")).count() == 0
