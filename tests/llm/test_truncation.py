import random

from heddle.llm import truncation

R = random.Random(3)
W = ["river", "council", "budget", "signal", "market", "harbor", "timber", "garden", "letter", "window", "people", "school", "report", "number"]


def prose(n):
    return " ".join(" ".join(R.choice(W) for _ in range(7)).capitalize() + "." for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "id bigint, source string, abstract string, content string, field string, key int")


def cut(spark, rows):
    return {(r.item_id, r.field) for r in truncation.truncated(table(spark, rows)).where("is_cut").collect()}


def corpus():
    return [(i, "a", prose(3), prose(6) + f"\nShare this post {i}") for i in range(30)]


def test_endings(spark):
    whole = ["Tags: river, council, market", "• The council moved the market", "https://a.example/notes/1", "A river “moved.”", prose(1), "Share this post", "timber garden"]
    bad = ["The river council mark", "The council of the…", "The river moved the... Read more", "A budget &am", "A budget <a hre", "The budget �", "Tags: river, coun", "Tags: river, council,", "The river moved the [Continue reading →]"]
    rows = corpus() + [(100 + i, "b", t, prose(2)) for i, t in enumerate(whole)] + [(200 + i, "b", t, prose(2)) for i, t in enumerate(bad)]
    got = cut(spark, rows)
    assert got == {(200 + i, "abstract") for i in range(len(bad))}


def test_marks_of_any_length(spark):
    path = "/".join(R.choice(W) for _ in range(60))
    bad = [f'The market moved. <a href="https://a.example/{path}', f"{prose(2)} <p class='x' id", prose(2) + "\ufffd" * 300, f"{prose(1)} The river moved the…" + " " * 400]
    whole = ["The budget held (p < 0.05) for the council.", f"If x <y and so on, the river holds. {prose(4)}", f"{prose(1)} <b>The river</b> moved."]
    rows = corpus() + [(100 + i, "b", t, None) for i, t in enumerate(whole)] + [(200 + i, "b", t, None) for i, t in enumerate(bad)]
    assert cut(spark, rows) == {(200 + i, "abstract") for i in range(len(bad))}


def test_revisions_cut_in_one_line_make_it_no_known_line(spark):
    base = [prose(1) for _ in range(12)]
    copies = []
    for i in range(40):
        lines = list(base)
        lines[R.randrange(12)] = f"{prose(1)} {'x' * (1 + 3 * i)}."
        copies.append((500 + i, "d", None, "\n".join([*lines, "The harbor council of timb"])))
    long = "Read the letter of the people of the harbor, who moved the market and the garden, in the window of the council, and send the school a report on the number of the signal, or a budget"
    notices = [(600 + i, "e", None, f"{prose(4 + i % 9)}\n{long}") for i in range(20)]
    others = [(i, "a", None, f"{prose(4 + i % 9)}\nShare this post {i}") for i in range(30)]
    got = truncation.truncated(table(spark, others + copies + notices)).where("is_cut").collect()
    assert {(r.item_id, r.at_limit, r.marked) for r in got} == {(500 + i, False, False) for i in range(40)}


def test_hidden_limit_in_escaped_form(spark):
    rows = corpus()
    for i in range(40):
        t = prose(30).replace("river", "r & b")
        n = 0
        while sum(5 if c == "&" else 1 for c in t[:n]) < 400:
            n += 1
        if sum(5 if c == "&" else 1 for c in t[:n]) == 400:
            rows.append((300 + i, "c", None, t[:n]))
    limits = truncation.hidden_limits(table(spark, rows)).where("source = 'c'").collect()
    assert truncation.FORMS == list(truncation.lengths(truncation.F.lit("")))
    assert [(r.encoding, r.limit) for r in limits if r.encoding == "entity_escaped"] == [("entity_escaped", 400)]
    assert not [r for r in limits if r.encoding == "characters"]


def test_rates_nulls_and_empty(spark):
    rows = [*corpus(), (None, None, None, ""), (400, None, "The river mark", None), (401, "a", None, "word " * 30000), (400, None, "The river mark", None)]
    rates = {(r.source, r.field): r for r in truncation.truncation_rates(table(spark, rows)).collect()}
    assert rates[(None, "abstract")].n_cut == 2 and rates[("a", "content")].n_values == 31
    assert truncation.truncated(table(spark, [])).count() == 0
