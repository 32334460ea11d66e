from heddle.llm import lines

SCHEMA = "id bigint, source string, content string, line_hash string, h string, one int, _excess string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7, "z") for r in rows], SCHEMA)


def corpus():
    rows = []
    for i in range(40):
        rows.append((i, "a", f"Own text number {chr(97 + i % 26)}{'z' * (i // 26)} here.\n  Share this POST {i}\r\n\nClosing words of {'q' * (i + 1)}."))
    for i in range(40, 60):
        rows.append((i, "b", f"Another text {'w' * (i - 39)} stands.\nShare this post" if i < 41 else f"Another text {'w' * (i - 39)} stands."))
    return rows


def test_excessive_lines_are_found_and_taken_out(spark):
    t = table(spark, corpus())
    found = {tuple(r) for r in lines.excessive_occurrences(t).collect()}
    assert found == {(i, 2) for i in range(40)}
    clean = {r.item_id: r for r in lines.without_excessive_lines(t).collect()}
    assert clean[3].n_removed == 1 and "POST" not in clean[3].text and clean[3].text.count("\n") == 2
    assert clean[40].text.endswith("Share this post") and clean[40].n_removed == 0


def test_a_line_common_to_all_sources_counts_in_each(spark):
    rows = [(s * 100 + i, f"s{s}", f"text {'x' * (i + 1)} of {'y' * (s + 1)}\nSkip to main content") for s in range(4) for i in range(20)]
    assert lines.excessive_occurrences(table(spark, rows)).count() == 80


def test_limits_of_count_and_share(spark):
    rows = [(i, "a", f"t{'x' * i}\nNotice" if i < 4 else f"t{'x' * i}") for i in range(20)]
    rows += [(100 + i, "b", f"u{'x' * i}\nRare" if i < 5 else f"u{'x' * i}") for i in range(80)]
    assert lines.excessive_occurrences(table(spark, rows)).count() == 0


def test_a_line_as_frequent_outside_is_no_excess(spark):
    """10 of 100 items in one source, 9 of 100 in each of twenty others: the share alone would take it, the likelihood ratio doesn't."""
    rows = [(s * 1000 + i, f"s{s}", f"text {i} {'x' * s}\n" + ("Weather permitting" if i < (10 if s == 0 else 9) else "") + ("\nOurs alone" if s == 0 and i % 9 == 0 else "")) for s in range(21) for i in range(100)]
    rows = [(i, s, c.replace("text", "text " + "abcdefghij"[i % 10] * (1 + i // 10 % 10))) for i, s, c in rows]
    t = table(spark, rows)
    assert {r.n_items for r in lines.excessive_lines(t).collect()} == {12}
    assert {r.n_items for r in lines.excessive_lines(t, q=1e300).collect()} == {10, 12}


def test_nulls_empty_long_and_repeated(spark):
    rows = [*corpus(), (None, None, None), (900, "a", ""), (901, None, "word\n" * 20000), (902, "a", None), *corpus()[:2]]
    t = table(spark, rows)
    assert lines.excessive_occurrences(t).where("item_id < 40").count() == 42
    clean = {r.item_id: r for r in lines.without_excessive_lines(t).collect()}
    assert clean[902].text is None and clean[900].text == "" and clean[902].n_removed == 0
    empty = table(spark, [])
    assert lines.excessive_occurrences(empty).count() == 0 and lines.without_excessive_lines(empty).count() == 0
