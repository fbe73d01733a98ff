from agorascope.sources import files, schema


def test_word_and_source_lists(spark, tmp_path):
    (tmp_path / "w.txt").write_text("The\n# no\n\n of \n")
    assert sorted(r.word for r in files.read_words(spark, f"{tmp_path}/w.txt").collect()) == ["of", "the"]
    (tmp_path / "s.txt").write_text("cats (animals) # c\nDogs\n\ncats (x)\nbad line (\n# all\n")
    assert sorted((r.name, r.category) for r in files.read_sources(spark, f"{tmp_path}/s.txt").collect()) == [("Dogs", "general"), ("cats", "animals")]


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("t", "1", 0, "NEAR", "p", "0.500000", 'line "one"\nline, two'), ("t", "x", 1, "FAR", "q", "1", "z"), ("t", "1", 1, "FAR", "q", "1", "z")], schema.CHUNK_POSTS_CSV)
    files.write_csv(rows, f"{tmp_path}/c")
    (got,) = files.read_chunk_posts(spark, f"{tmp_path}/c").collect()
    assert got.chunk_id == 1 and [p.text for p in got.posts] == ['line "one"\nline, two', "z"]


def test_json(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"post_id": "1"}\nnope\n{"post_id": "2"}\n')
    assert sorted(r.post_id for r in files.read_json_lines(spark, f"{tmp_path}/a.jsonl", "post_id string").collect()) == ["1", "2"]
    (tmp_path / "i.json").write_text('{"items": [{"a": 1}, {"a": 2}]}')
    assert sorted(r.a for r in files.read_items(spark, f"{tmp_path}/i.json", "a:int").collect()) == [1, 2]
    assert files.read_document(spark, f"{tmp_path}/none.json") is None and files.read_document(spark, f"{tmp_path}/i.json").startswith("{")
    for n in (10, 2):
        (tmp_path / f"batch_{n}_input.json").write_text('{"post_id": "%d"}' % n)
    assert [r.batch_number for r in files.read_batches(spark, str(tmp_path), "post_id string").collect()] == [2, 10]


def test_terms_and_batches(spark, tmp_path):
    files.write_csv(spark.createDataFrame([("t", 3, "a|| b ", "0.5|0.1")], schema.TERMS_CSV), f"{tmp_path}/t")
    assert files.read_terms(spark, f"{tmp_path}/t").first().terms == ["a", " b "]
    rows = spark.createDataFrame([("4",), ("x",), ("12",)], "batch_id string")
    assert files.max_batch_id(rows).first()[0] == 12
