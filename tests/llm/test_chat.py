import random

from dqloom.llm.chat import linked, parse

TALK = [
    (1, 1, "user", "How do I sort a large table?\n\nIt has a billion rows."),
    (1, 2, "assistant", "> It has a billion rows.\n\nUse a range partitioning then."),
    (1, 3, "user", "A separate question about joins here."),
    (1, 4, "user", "On Monday someone wrote:\n> Use a range  partitioning THEN.\n>> It has a billion rows.\nThat works, thank you."),
    (1, 5, "assistant", "> A separate question about joins here.\nAnswer on joins."),
    (1, 6, "user", "> nobody ever said this line\nok"),
    (2, 1, "user", "> How do I sort a large table?\nquoted from elsewhere"),
    (2, 1, "user", None),
    (None, 1, "user", "> How do I sort a large table?\nno conversation"),
    (3, None, None, ""),
]


def test_parse():
    own, mine, quoted = parse("On x he wrote:\n> one two three\n> > four five six\n\nmy own words here\r\nand more")
    assert own == "my own words here\nand more"
    assert [level for level, _ in quoted] == [1, 2] and len(mine) == 2  # the passage and its first line; the second is too short
    assert parse("") == ("", [], [])


def test_links_and_order(spark):
    df = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string").withColumnRenamed("role", "role")
    rows = linked(df).collect()
    assert len(rows) == len(TALK)
    one = {r.turn: r for r in rows if r.conv_id == 1}
    assert {t: r.parent_turn for t, r in one.items()} == {1: None, 2: 1, 3: None, 4: 2, 5: 3, 6: None}
    assert {t: r.root_turn for t, r in one.items()} == {1: 1, 2: 1, 3: 3, 4: 1, 5: 3, 6: 6}
    assert sorted(one, key=lambda t: one[t].position) == [1, 2, 4, 3, 5, 6]
    assert [one[t].position for t in (1, 2, 4, 3, 5, 6)] == [1, 2, 3, 4, 5, 6]
    assert one[4].text == "That works, thank you." and (one[4].n_quotes, one[4].n_linked) == (2, 2)
    assert all(">" not in r.text for r in rows)
    assert sorted(r.position for r in rows if r.conv_id == 2) == [1, 2] and all(r.parent_turn is None for r in rows if r.conv_id != 1)


def test_long_chain_and_empty(spark):
    rows = [(7, k, "user", (f"> message number {k - 1} says\n" if k else "") + f"message number {k} says") for k in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in linked(df).collect()}
    assert all(got[k].parent_turn == k - 1 and got[k].root_turn == 0 and got[k].position == k + 1 for k in range(1, 40))
    assert linked(df.limit(0)).count() == 0


def test_short_and_unspaced_quotes_are_linked(spark):
    talk = [
        (1, 1, "user", "Shall we start?"),
        (1, 2, "assistant", "Yes, agreed"),
        (1, 3, "user", "> yes,  AGREED\nGood."),
        (1, 4, "user", "> Why not?\nNobody said it."),
        (1, 5, "assistant", "我同意这个计划。\n明天开始。"),
        (1, 6, "user", "> 明天开始。\n好"),
        (1, 7, "user", "> 好\nそうです"),
        (1, 8, "assistant", "> そうです\n> > 明天开始。\nok"),
        (1, 9, "user", "> ok\nend"),
    ]
    got = {r.turn: r for r in linked(spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")).collect()}
    assert {t: r.parent_turn for t, r in got.items()} == {1: None, 2: None, 3: 2, 4: None, 5: None, 6: 5, 7: 6, 8: 7, 9: 8}
    assert {t: r.root_turn for t, r in got.items()} == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5}
    assert {t: (r.n_quotes, r.n_linked) for t, r in got.items() if t in (3, 4, 6, 8)} == {3: (1, 1), 4: (1, 0), 6: (1, 1), 8: (2, 2)}


def brute(talk):
    """Parent and root of each message, message by message: passages and lines are compared as texts, without hashes or joins."""
    import re

    def squeezed(text):
        return re.sub(r"[\x20\x09-\x0d]+", " ", text).strip(" ").lower()

    def units(text, level):
        """Passages of a quote level and their longer lines."""
        out, run, before = set(), [], None
        for line in [*text.split("\n"), None]:
            mark = re.match(r"(?:[ \t]*>)+", line) if line is not None else None
            at, body = (mark[0].count(">"), line[mark.end():].strip(" \t")) if mark else (0, line)
            blank = line is None or not body.strip()
            if line is None or blank or at != before:
                if run and before is not None and (before > 0) == (level > 0) and (level in (0, before)):
                    out.add(squeezed("\n".join(run)))
                    out |= {squeezed(x) for x in run if len(squeezed(x).encode()) >= 9 or len(squeezed(x).split(" ")) >= 3}
                run = []
            if not blank:
                run.append(body)
            before = None if blank else at
        return out

    parent = {}
    for conv, turn, text in talk:
        said = [t for c, t, other in talk if c == conv and t < turn and units(text, 1) & units(other, 0)]
        # Each quoted unit points to the earliest message that has it; the latest of those is the parent.
        first = [min(t for c, t, other in talk if c == conv and u in units(other, 0)) for u in units(text, 1) if any(c == conv and u in units(o, 0) for c, _, o in talk)]
        first = [t for t in first if t < turn]
        assert bool(first) <= bool(said)
        parent[conv, turn] = max(first, default=None)

    def root(conv, turn):
        while parent[conv, turn] is not None:
            turn = parent[conv, turn]
        return turn

    return {k: (p, root(*k)) for k, p in parent.items()}


def test_links_equal_brute_force(spark):
    rng = random.Random(4)
    talk, lines = [], [f"{a} {b} number {k}" for k, (a, b) in enumerate((x, y) for x in ("alpha", "beta", "yes") for y in ("gamma", "delta", "no"))] + ["ok", "Why not?", "明天开始。"]
    for conv in range(12):
        for turn in range(12):
            parts = []
            for _ in range(rng.randint(1, 3)):
                said = [rng.choice(lines) for _ in range(rng.randint(1, 2))]
                mark = rng.choice(["", "> ", ">", "> > "])
                parts.append("\n".join(mark + (x.upper() if rng.random() < 0.2 else x) for x in said))
            talk.append((conv, turn, "\n\n".join(parts)))
    df = spark.createDataFrame([(c, t, "user", x, c, x) for c, t, x in talk], "conv_id long, turn long, role string, text string, h long, own string")
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn) for r in linked(df).collect()}
    assert got == brute(talk) and sum(p is not None for p, _ in got.values()) > 20
