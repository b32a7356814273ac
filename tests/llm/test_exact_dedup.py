from marketlake.llm import exact_dedup


def test_every_row_gets_its_group(make, rows):
    docs = make((1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "a "), (7, "x" * 100_000), (8, "x" * 100_000))
    found = rows(exact_dedup.decisions(docs), "doc_id", "keep_id", "group_size", "kept")
    assert found == [
        (1, 3, 2, False),
        (2, 2, 1, True),
        (3, 3, 2, True),
        (4, 5, 2, False),
        (5, 5, 2, True),
        (6, 6, 1, True),
        (7, 8, 2, False),
        (8, 8, 2, True),
    ]


def test_repeated_rows_and_null_ids_keep_one(make, rows):
    docs = make((None, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b"))
    found = rows(exact_dedup.decisions(docs), "doc_id", "keep_id", "group_size", "kept")
    assert sorted(found, key=str) == sorted(
        [(None, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True), (None, None, 2, False), (None, None, 2, True)], key=str
    )
    kept = rows(exact_dedup.deduplicated(docs), "doc_id", "text")
    assert kept == [(None, "b"), (1, "a")]


def test_frequent_and_rare_groups_agree(make, rows):
    """Whether a group is frequent changes the way it is settled, not the result."""
    docs = make(*[(i, "hot" if i % 3 == 0 else f"t{i % 40}") for i in range(300)])
    columns = ("doc_id", "keep_id", "group_size", "kept")
    all_rare = rows(exact_dedup.decisions(docs, support=1.0), *columns)
    assert rows(exact_dedup.decisions(docs, support=0.1), *columns) == all_rare
    assert rows(exact_dedup.decisions(docs, support=0.001), *columns) == all_rare
    assert sum(kept for *_, kept in all_rare) == 41


def test_equal_digests_meet_in_the_summary(make):
    table = exact_dedup.digest_table(make(*[(i, "hot") for i in range(50)], (99, "cold")))
    groups = exact_dedup.duplicate_groups(table, support=0.5)
    assert [(r["group_size"], r["keep_id"]) for r in groups.frequent.collect()] == [(50, 49)]
    assert groups.rest.count() == 0


def test_kept_rows_have_all_columns(make):
    docs = make((1, "a", "en", "s"), (2, "a", "fr", "t"), (3, "b", None, None))
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["lang"], r["row"]) for r in kept.collect()) == [(2, "fr", "clash"), (3, None, "clash")]


def test_empty_table(make):
    empty = make((1, "a")).limit(0)
    assert exact_dedup.decisions(empty).count() == 0
    assert exact_dedup.deduplicated(empty).count() == 0
