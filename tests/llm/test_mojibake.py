import pytest

from newsloom.llm import mojibake as M
from tests.conftest import DATA

CLEAN = [
    "La policía de Dusbunar prepara el precio de la luz después de la votación en toda la región",
    "Die Behörde verschiebt die Schließung der Bücherei für fünf Wochen, sagte die Bürgermeisterin",
    "Le théâtre réclame une campagne très attendue à l'hôpital, a déclaré la mairie de la région",
    "Полиция города останавливает финальный матч после пяти часов переговоров и закрывает школу",
    "Mestni svet obljublja nov most, čeprav šola pričakuje poročilo o pitni vodi in cene elektrike že",
    "A padaria não irá recuar, disse o ministério à imprensa após a votação sobre a água potável já",
]


@pytest.fixture(scope="module")
def corpus(spark):
    return M.corpus_of(spark.createDataFrame([(t,) for t in CLEAN * 40], "text string"))


@pytest.mark.parametrize("read", ["cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850"])
@pytest.mark.parametrize("k", range(len(CLEAN)))
def test_utf8_read_in_another_charset_comes_back(corpus, read, k):
    try:
        bad = "".join(M.WRITE[read][b] if b > 127 else chr(b) for b in CLEAN[k].encode())
    except KeyError:
        pytest.skip("a byte that the charset lacks")
    assert M.examine(bad, corpus)[0] and M.restore(bad, corpus) == CLEAN[k]


@pytest.mark.parametrize("true,read,k", [("cp1251", "cp1252", 3), ("koi8_r", "cp1251", 3), ("cp866", "cp1251", 3), ("cp1250", "cp1252", 4), ("mac_roman", "cp1252", 0), ("cp1252", "mac_roman", 2), ("cp1252", "cp437", 5)])
def test_one_byte_channels(corpus, true, read, k):
    bad = "".join(c if c < "\x80" else M.WRITE[read].get(M.READ[true].get(c, 63), "?") for c in CLEAN[k])
    assert bad != CLEAN[k] and M.examine(bad, corpus)[0]
    assert M.restore(bad, corpus) == CLEAN[k]


def test_twice_garbled(corpus):
    bad = CLEAN[2].encode().decode("latin_1").encode().decode("latin_1")
    assert M.restore(bad, corpus) == CLEAN[2]


def test_lost_bytes(corpus):
    bad = CLEAN[0].encode("latin_1").decode("utf_8", "replace")
    good, lost, _ = M.examine(bad, corpus)
    assert lost == 4 and "policía" in M.restore(bad, corpus)


@pytest.mark.parametrize("text", CLEAN)
def test_sound_text_is_left(corpus, text):
    assert M.examine(text, corpus) == ([], 0, {})


def test_frame_edges(spark, corpus):
    bad = CLEAN[0].encode().decode("cp1252", "replace")
    rows = [(1, CLEAN[0], 1), (2, bad, 2), (2, bad, 2), (3, None, 3), (4, "", 4), (5, "plain", 5), (None, bad, 6), (6, (CLEAN[1] + " ") * 3000, 7)]
    df = spark.createDataFrame(rows, "id long, text string, lost int")
    assert sorted(r.id for r in M.garbled(df, corpus).collect()) == [2, 2]
    assert M.garbled(df.limit(0), corpus).count() == 0
    assert M.corpus_of(df.limit(0).select("text")).count("x") == 0


def test_pages_of_the_test_data(spark):
    """Pages with characters no charset of the seven languages has are found, sound ones mostly not."""
    from newsloom.llm.queries import p3_found

    got = {r[0] for r in p3_found(spark, DATA).collect()}
    utf8 = {r[0] for r in spark.read.parquet(f"{DATA}/feed_article_meta.parquet").where("is_utf8 = '1'").select("id").collect()}
    odd = set()
    for r in spark.read.parquet(f"{DATA}/article.parquet").where("content is not null").collect():
        if r.feed_articleid in utf8 and any(c in "™√├\u00a4╢\ufffd" for c in bytes(r.content).decode("utf_8", "replace")):
            odd.add(r.feed_articleid)
    assert odd <= got and len(got) <= len(odd) + 6


def test_references_are_read_first(corpus):
    """Garbled characters written as character references are found; markup references and sound ones stay."""
    bad = "".join(f"&#{ord(c)};" if c > "\x7f" else c for c in CLEAN[1].encode().decode("cp1252"))
    page = f"<p>a &lt;b&gt; &amp; {bad}</p>"
    assert M.examine(M.plain(page), corpus)[0] and M.restore(page, corpus) == f"<p>a &lt;b&gt; &amp; {CLEAN[1]}</p>"
    good = "".join(f"&#{ord(c)};" if c > "\x7f" else c for c in CLEAN[3])
    assert M.examine(M.plain(good), corpus)[0] == [] and M.restore(good, corpus) == good


def test_lattices_with_wildcards(corpus):
    """Bytes lost within a misread token, letters that left two marks, and many lost bytes are restored; a token of which no letter survives isn't."""
    quoted = "”"
    assert M.lattice("â€" + M.MARK, "cp1252") == [0xE2, 0x80, -1]
    assert [s for _, s in M.paths([0xD1, -1, 0xD0, 0xBE], "utf_8", corpus)]
    two = CLEAN[1].replace("ü", M.MARK * 2).replace("ö", M.MARK * 2).replace("ß", M.MARK * 2)
    assert M.restore(two, corpus) == CLEAN[1]
    many = CLEAN[4].encode("cp1250").decode("utf_8", "replace")
    assert "šola pričakuje poročilo" in M.restore(many, corpus)
    assert M.filled(M.MARK * 6, corpus) == (None, "") and quoted in M.PLAIN


def test_a_garbled_third_of_the_corpus_is_found(spark):
    """The rule looks at ratios, so a host with a third of all pages garbled alike is found at any size."""
    bad = "".join(c if c < "\x80" else M.WRITE["cp1252"].get(M.READ["cp1250"].get(c, 63), "?") for c in CLEAN[4])
    for times in (10, 400):
        c = M.corpus_of(spark.createDataFrame([(t,) for t in [*CLEAN, CLEAN[4], bad] * times], "text string"))
        assert M.examine(bad, c)[0], times
        assert M.examine(CLEAN[4], c)[0] == []


def test_sums_over_many_tasks():
    """Arrays of 200 simulated tasks are added in a tree of three levels."""
    import numpy as np
    import pyarrow as pa

    from newsloom.llm import sketch

    parts = [sketch.blobs(np.full(8, k, np.uint64), 2).set_column(0, "task", pa.array([k, k], pa.int32())) for k in range(200)]
    rows = pa.Table.from_batches(parts)
    one = pa.concat_tables([sketch._add(rows.filter(pa.array([c == 1 and t // sketch.FAN == g for t, c in zip(rows["task"].to_pylist(), rows["chunk"].to_pylist())]))) for g in range(4)])
    assert one.num_rows == 4 and one["task"].to_pylist() == [0, 1, 2, 3]
    import zstandard

    total = np.frombuffer(zstandard.ZstdDecompressor().decompress(sketch._add(one)["blob"][0].as_py()), np.uint64)
    assert total.tolist() == [199 * 100] * 4
