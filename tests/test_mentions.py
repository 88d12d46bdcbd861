from contentflow.operators import mentions as M


def test_phrase_across_line_breaks_not_nbsp(spark):
    df = spark.createDataFrame([(1, 1, "Roi\ndes\t pirates"), (1, 2, "roi des pirates"), (1, 3, None)],
                               "chapter_number long, page_number long, extracted_text string")
    assert [r.page_number for r in M.with_phrase(df, "roi des pirates").collect()] == [1]


def test_mentions_json_cases(spark):
    rows = [
        (1, 1, '{"mentions":[{"speaker":"Luffy","phrase":"p","luffy_says_it":true,"about_luffy":false}]}'),
        (1, 2, '```json\n{"mentions":[{"phrase":"q"}]}\n```'),
        (1, 3, '{"mentions":[{"speaker":"a"'),
        (1, 4, '[{"speaker":"a"}]'),
        (1, 5, '{"mentions":null}'),
        (1, 6, '{}'),
        (1, 7, '{"mentions":[{"speaker":null,"phrase":"r"},{"phrase":"s"},"bad",{"phrase":"t"}]}'),
    ]
    df = spark.createDataFrame(rows, "chapter_number long, page_number long, raw string")
    good, bad = M.mentions_from_responses(df)
    def k(t):
        return tuple(str(x) for x in t)
    g = sorted(((r.page_number, r.speaker, r.phrase, r.luffy_says_it, r.about_luffy) for r in good.collect()),
               key=k)
    assert g == sorted([(1, "Luffy", "p", True, False), (2, "inconnu", "q", False, False),
                        (7, None, "r", False, False), (7, "inconnu", "s", False, False),
                        (7, "inconnu", "t", False, False)], key=k)
    b = sorted((r.page_number, r.reason) for r in bad.collect())
    assert b == [(3, "unparseable"), (4, "not_object"), (5, "mentions_not_array"), (7, "bad_mention")]
    lit, _ = M.mentions_from_responses(df, literal=True)
    assert sorted(r.phrase for r in lit.where("page_number = 7").collect()) == ["r", "s"]


def test_worklist_skips_processed_pages(spark):
    d = spark.createDataFrame([(1, 1, "le roi des pirates"), (1, 2, "roi des\npirates"), (2, 1, "rien")],
                              "chapter_number long, page_number long, extracted_text string")
    s = spark.createDataFrame([(1, 1)], "chapter_number long, page_number long")
    w = M.mention_worklist(d, s).collect()
    assert [(r.chapter_number, r.page_number) for r in w] == [(1, 2)]
    assert "(chapitre 1, page 2)" in w[0].request and "TEXTE:\nroi des\npirates\n" in w[0].request


def test_rule_tagger(spark):
    d = spark.createDataFrame(
        [(1, 1, "Je serai le roi des pirates! Luffy sera le roi des pirates. Rien ici.")],
        "chapter_number long, page_number long, extracted_text string")
    r = sorted((x.sidx, x.luffy_says_it, x.about_luffy) for x in M.mentions_by_rules(d).collect())
    assert r == [(0, True, False), (1, False, True)]


def test_ledger_statuses(spark):
    rows = [(1, 1, '{"mentions":[{"phrase":"p"}]}'), (1, 2, '{"mentions":[]}'), (1, 3, '{}'),
            (1, 4, '{"mentions":[{"phrase":"p"},"x"]}'), (1, 5, 'nope'), (1, 6, '{"mentions":null}')]
    df = spark.createDataFrame(rows, "chapter_number long, page_number long, raw string")
    got = {r.page_number: (r.status, r.n_mentions, r.n_bad) for r in M.page_ledger(df).collect()}
    assert got == {1: ("mentions", 1, 0), 2: ("no_mention", 0, 0), 3: ("no_mention", 0, 0),
                   4: ("partial", 1, 1), 5: ("failed", 0, 0), 6: ("failed", 0, 0)}
