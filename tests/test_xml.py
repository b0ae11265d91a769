"""XML import on hand-written records (cases the rendered tables do not
reach), ACM records, quality report and the streaming import."""

import os
import random
from xml.etree import ElementTree

from pyspark.sql import functions as F

from citecube.sources import xml_records as xml
from citecube.session import scratch_path

DBLP = """<?xml version="1.0" encoding="ISO-8859-1"?>
<!DOCTYPE dblp SYSTEM "dblp.dtd">
<dblp>
<article mdate="2014-07-02" key="journals/demo/QuillO07">
<author>Mara Quill</author>
<author>Tomas Oakes</author>
<title>On "Lazy" Ledgers.</title>
<pages>31-40</pages>
<year>2007</year>
<volume>12</volume>
<journal>Demo J. Ledgers</journal>
<number>4</number>
<ee>http://example.org/ledgers</ee>
<cite>journals/demo/Quill05</cite>
</article>
<inproceedings mdate="2017-05-24" key="conf/x/M1"><author>J&ouml;rg M&uuml;ller</author><title>Tom &amp; <i>Jerry</i> H<sub>2</sub>O</title><year> 2001</year><year>2002</year><booktitle>Conf X</booktitle><crossref>conf/x/2002</crossref><journal>J Y</journal><cite>...</cite><cite>a|b</cite></inproceedings><article key="journals/y/Z2" mdate="2017-01-01"><author>A|B</author><title>T2</title><year>2003</year><year>20x4</year><journal>J Z</journal><booktitle>B Z</booktitle><number>7</number></article>
<article mdate="2017-01-01" key="journals/y/NoAuthor"><title>Lonely</title><year>2000</year></article>
<article mdate="2017-01-01" key="journals/y/BadYear"><author>X</author><title>Bad</title><year>19x3</year></article>
<www mdate="2017-01-01" key="homepages/x/Y"><author>Y</author><title>Home Page</title></www>
<proceedings mdate="2017-01-01" key="conf/x/2002"><title>Proc X 2002</title><year>2002</year></proceedings>
<book mdate="2017-01-01" key="books/b/1"><author>Q</author><title>A Book</title><foo>unknown</foo></book>
<article mdate="2017-01-01" key="journals/y/Broken"><author>Z</author><title>Broken</titel><year>2001</year></article>
</dblp>
"""


def write(tmp, name, text):
    d = os.path.join(tmp, name)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.xml"), "w", encoding="utf-8") as fh:
        fh.write(text)
    return d


def test_dblp_import_fixture(spark, tmp_path):
    path = write(str(tmp_path), "dblp", DBLP)
    pubs, cols = xml.dblp_import(spark, path)
    got = {r.key: r.asDict() for r in pubs.collect()}
    assert set(got) == {"journals/demo/QuillO07", "conf/x/M1", "journals/y/Z2"}
    q = got["journals/demo/QuillO07"]
    assert q["type"] == "article" and q["year"] == 2007 and q["seq"] == 1
    assert q["title"] == 'On "Lazy" Ledgers.'
    assert q["venue"] == "Demo J. Ledgers#12#4"
    assert q["authors"] == "Mara Quill|Tomas Oakes" and q["cites"] == "journals/demo/Quill05"
    m1 = got["conf/x/M1"]
    assert m1["authors"] == "Jörg Müller"          # named entities
    assert m1["title"] == "Tom & Jerry H2O"                   # markup flattened, &amp; decoded
    assert m1["year"] == 2002                                 # ' 2001' is not a number
    assert m1["venue"] == "ref:conf/x/2002"                   # crossref wins over journal
    assert m1["cites"] == "a-b"                               # '...' dropped, '|' -> '-'
    z2 = got["journals/y/Z2"]
    assert z2["year"] == 2003                                 # bad last year keeps the good one
    assert z2["venue"] == "B Z#0#7"                           # booktitle after journal wins; issue only
    assert z2["authors"] == "A-B"
    assert (got["conf/x/M1"]["seq"], got["journals/y/Z2"]["seq"]) == (2, 3)     # by place
    assert sorted((r.type, r.key, r.title) for r in cols.collect()) == [
        ("book", "books/b/1", "A Book"), ("proceedings", "conf/x/2002", "Proc X 2002")]


def test_quality_report(spark, tmp_path):
    path = write(str(tmp_path), "dblpq", DBLP)
    rep = {r.rule: r.n for r in xml.quality_report(spark, path).collect()}
    assert rep == {"unknown_field": 1, "malformed_record": 1}


ACM = """<?xml version="1.0"?>
<PublicationList>
<Publication id="P1"><Title>Query <i>Plans</i></Title><Venue year="1999">Volume 12 , Issue 3 (May 1999)</Venue>
<VenueSeries>
  ACM SIGMOD #Record </VenueSeries><Name>Ann</Name><Name>Bob</Name><CitingPub>x</CitingPub><CitingPub>y</CitingPub></Publication>
<Publication id="P2"><Title>No volume</Title><Venue year="2001">Proceedings</Venue><VenueSeries>VLDB</VenueSeries><Name>Cid</Name></Publication>
<Publication id="P3"><Title>Bad year</Title><Venue year="n/a">x</Venue><Name>Dan</Name></Publication>
</PublicationList>
"""


def test_acm_import_fixture(spark, tmp_path):
    path = write(str(tmp_path), "acm", ACM)
    got = {r.source_id: r.asDict() for r in xml.acm_import(spark, path).collect()}
    assert set(got) == {"P1", "P2"}
    assert got["P1"]["title"] == "Query Plans" and got["P1"]["year"] == 1999
    assert got["P1"]["venue"] == "ACM SIGMOD :Record#12#3"
    assert got["P1"]["authors"] == "Ann|Bob" and got["P1"]["num_citings"] == 2
    assert got["P2"]["venue"] == "VLDB" and got["P2"]["num_citings"] == 0


def test_streaming_import_matches_batch(spark, tmp_path):
    from citecube.streaming.incremental import run_dblp_import, staged_tables
    src = write(str(tmp_path), "in", DBLP)
    target, ckpt = scratch_path(spark, "t-stream"), scratch_path(spark, "t-ckpt")
    run_dblp_import(spark, src, target, ckpt)
    pubs, cols = staged_tables(spark, target)
    batch = xml.dblp_import(spark, src)
    for stream, whole in ((pubs, batch[0]), (cols, batch[1])):
        assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, whole.collect()))
    # a second run with no new files adds nothing
    run_dblp_import(spark, src, target, ckpt)
    assert staged_tables(spark, target)[0].count() == pubs.count()


def _named(star):
    """The fact with natural keys in place of ids."""
    f = (star.publication.join(star.title.select("title_id", "title", "source_key"), "title_id")
         .join(star.timeinfo.select("time_id", "year"), "time_id").join(star.author, "author_id")
         .join(star.document_type.select("type_id", F.col("name").alias("type")), "type_id")
         .join(star.venue_series.select("venue_series_id", "dblp_key"), "venue_series_id", "left"))
    return sorted(map(str, f.select("source_key", "title", "year", "type", "name", "dblp_key", "citings_dblp").collect()))


def test_refresh_keeps_ids_and_equals_a_batch_build(spark, tmp_path):
    from citecube.plans.star import build_star
    from citecube.sources import adapter
    from citecube.streaming import incremental as inc
    rng = random.Random(4)
    keys = [f"a/{i}" for i in range(60)]

    def day(n):
        body = [f'<article key="{k}"><author>{rng.choice("ABCDEFGH")}</author><author>N{n}</author><title>T {k} {n}</title>'
                f'<year>{1990 + rng.randrange(4 + n)}</year><crossref>c/{rng.randrange(6)}</crossref>'
                f'<cite>{rng.choice(keys)}</cite></article>' for k in rng.sample(keys, 25)]
        body.append(f'<proceedings key="c/{n}"><title>C {n}</title></proceedings>')
        return f"<dblp>{chr(10).join(body)}</dblp>"

    src, target, ckpt = str(tmp_path / "in"), scratch_path(spark, "t-refresh"), scratch_path(spark, "t-refresh-ckpt")
    os.makedirs(src)
    ids = {}
    for n in range(2):
        with open(os.path.join(src, f"day-{n}.xml"), "w") as fh:
            fh.write(day(n))
        inc.run_dblp_import(spark, src, target, ckpt)
        now = {r.author: r.author_id for r in inc.registries(spark, target)["author"].table().collect()}
        assert ids.items() <= now.items() and sorted(now.values()) == list(range(1, len(now) + 1))
        ids = now
    staged = [sorted(map(tuple, t.collect())) for t in inc.staged_tables(spark, target)]
    # the last batch comes once more, as after a failure: nothing changes
    raw = (spark.read.option("lineSep", xml.KEY_SEP).text(os.path.join(src, "day-1.xml"))
           .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.col("value").alias("chunk")))
    counts = inc.import_batch(raw, 1, target)
    assert counts["publication"] == 25 and counts["collection"] == 1 and counts["reject"] == 0
    assert staged == [sorted(map(tuple, t.collect())) for t in inc.staged_tables(spark, target)]
    assert ids == {r.author: r.author_id for r in inc.registries(spark, target)["author"].table().collect()}
    pubs, cols = xml.dblp_import(spark, src)
    batch = build_star(adapter.staged_from_records(*(t.withColumnRenamed("seq", "id") for t in (pubs, cols))))
    assert _named(inc.stable_star(spark, target)) == _named(batch)


def _dump(spark, body):
    path = scratch_path(spark, "dump")
    spark.createDataFrame([(f"<dblp>\n{body}\n</dblp>",)], "value string").coalesce(1).write.text(path)
    return path


def _article(attrs, title="T", author="A"):
    return f"<article {attrs}><author>{author}</author><title>{title}</title><year>2001</year></article>"


def test_no_record_is_lost(spark):
    body = "\n".join([_article('key="k1"'), _article("mdate='x' key='k2'"), _article("mdate='x'\n key = \"k3\""),
                      _article("mdate='x'", title="no key"), _article('key="k5"', title="on &lt;i&gt; tags <i>in</i>"),
                      _article('key="k6"', author="S&scaron; &undeclared;"), _article('key="k7"')])
    path = _dump(spark, body)
    pubs, _ = xml.dblp_import(spark, path, with_seq=False)
    got = {r.key: r.title for r in pubs.collect()}
    rejects = {(r.reason, r.key) for r in xml.dblp_rejects(spark, path).collect()}
    assert set(got) == {"k1", "k2", "k3", "k5", "k7"} and got["k5"] == "on <i> tags in"
    assert rejects == {("missing_key", None), ("malformed_record", "k6")}


def test_acm_fields_at_any_depth(spark):
    path = scratch_path(spark, "acm")
    text = ("<Ps><Publication\n id='3'><Title>T</Title><Venue year='2001'>Volume 1 , Issue 2</Venue>"
            "<Authors><Author><Name>A</Name></Author><Author><Name>B</Name></Author></Authors>"
            "<Citings><CitingPub/><CitingPub>x</CitingPub></Citings></Publication></Ps>")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    rows = xml.acm_import(spark, path, with_seq=False).collect()
    assert [(r.source_id, r.authors, r.num_citings) for r in rows] == [("3", "A|B", 2)]


def _hostile_dump(rng, many):
    """Records whose texts, comments and CDATA hold what opens a record's key."""
    out = []
    for i in range(many):
        title = rng.choice(["plain", 'the attribute key="v" in XML', '<![CDATA[raw <article key="c">]]> end', "a <i>b</i> > c",
                            '<!-- <x key="in"> -->kept', '<?pi key="p"?>x', '<![CDATA[<!-- ]]>no comment<![CDATA[ --> key="q"]]>'])
        attrs = rng.choice([f'mdate="2015" key="k{i}"', f'key="k{i}" mdate="2015"', f"mdate='x' key='k{i}'", f'mdate="x"\nkey="k{i}"'])
        kind = rng.choice(["article", "article", "proceedings", "www"])
        out.append(f"<{kind} {attrs}><author>A{i}</author><title>{title} {i}</title><year>2001</year></{kind}>")
        out.append(rng.choice(["", "\n", "\n", f'<!-- gone <article key="g{i}"><title>G</title></article> -->',
                               "<!--" + f'<article mdate="x" key="h{i}"><title>H</title></article>\n' * 5 + "-->",
                               f'<person key="p{i}"><author>P</author></person>']))
    return "<dblp>\n" + "".join(out) + "\n</dblp>"


def test_records_are_whole_and_in_place(spark, tmp_path, split=700):
    rng = random.Random(split)
    want = {"publication": [], "collection": []}
    for n in range(2):
        text = _hostile_dump(rng, 25)
        (tmp_path / f"part-{n}.xml").write_text(text)
        for e in ElementTree.fromstring(text):
            kind = {"article": "publication", "proceedings": "collection"}.get(e.tag)
            if kind:
                want[kind].append((e.get("key"), "".join(e.find("title").itertext())))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, split)
        rows, counts = xml.dblp_table(spark, str(tmp_path))
        pubs, cols = xml.split_kinds(rows, with_seq=True)
        rejects = xml.rejects_of(rows).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert rejects == []
    assert [(r.key, r.title) for r in sorted(pubs.collect(), key=lambda r: r.seq)] == want["publication"]
    assert [(r.key, r.title) for r in sorted(cols.collect(), key=lambda r: r.seq)] == want["collection"]
    assert [r.seq for r in sorted(pubs.collect(), key=lambda r: r.seq)] == list(range(1, len(want["publication"]) + 1))
    assert counts == {"publication": len(want["publication"]), "collection": len(want["collection"]), "reject": 0}


def test_numbering_neither_ranges_nor_sorts_by_contents(spark, tmp_path):
    path = write(str(tmp_path), "n", DBLP)
    pubs, _ = xml.dblp_import(spark, path)
    plan = pubs._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning(src" in plan


def test_elements_with_a_key_that_are_no_record(spark):
    path = _dump(spark, '<article key="k1"><author>A</author><note key="x">n</note><title>T</title><year>2001</year></article>')
    pubs, _ = xml.dblp_import(spark, path, with_seq=False)
    assert [(r.key, r.title) for r in pubs.collect()] == [("k1", "T")]
    assert {r.rule: r.n for r in xml.quality_report(spark, path).collect()} == {"unknown_element": 1}


def test_rendered_dump_is_compressed_files_of_bounded_records(spark, monkeypatch):
    from citecube.session import scratch_path
    from citecube.sources import xml_records

    monkeypatch.setattr(xml_records, "RECORDS_PER_FILE", 10)
    body = spark.range(90).selectExpr("concat('<article key=\"a/', id, '\"><author>n</author><title>t', id, '</title><year>1999</year>"
                                      "</article>') as value", "id as o").repartition(3)
    path = scratch_path(spark, "t-dump")
    xml_records.write_xml([body], path, "<dblp>", "</dblp>")
    assert all(f.endswith(".gz") for f in spark.read.text(path).inputFiles())
    assert max(r["count"] for r in spark.read.text(path).groupBy("_metadata.file_path").count().collect()) <= 10
    got = xml_records.dblp_import(spark, path)[0].select("seq", "key").collect()
    assert sorted(map(tuple, got)) == [(i + 1, f"a/{i}") for i in range(90)]
