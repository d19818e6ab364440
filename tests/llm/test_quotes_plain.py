"""Quotation linking against a plain version: messages one by one, every earlier message looked at."""

import random
import re

import pytest

from tablewright.llm import quotes


def split(text):
    """Passages as (level, lines): consecutive lines of one level, ended by empty lines."""
    out, last = [], None
    for line in re.split(r"\r\n?|\n", text or ""):
        marks = re.match(r"(?:[ \t]{0,3}>)+", line)
        at = marks.group().count(">") if marks else 0
        words = " ".join((line[marks.end() :] if marks else line).casefold().split())
        if not words:
            last = None
            continue
        if last != at:
            out.append((at, []))
        last = at
        out[-1][1].append(words)
    return out


def plain(messages):
    """(conv, turn, text) in any order to what the operator adds, in the same order."""
    said = []
    for conv, turn, text in messages:
        own = [lines for at, lines in split(text) if not at]
        keys = {" ".join(lines) for lines in own} | {line for lines in own for line in lines} | {" ".join(x for lines in own for x in lines)}
        said.append((conv, turn, keys - {""}))

    def latest(conv, turn, key):
        return max((t for c, t, keys in said if c == conv and t is not None and (turn is None or t < turn) and key in keys), default=None)

    out = []
    for conv, turn, text in messages:
        weights, n, linked, passages = {}, 0, 0, 0
        for at, lines in split(text):
            if not at:
                continue
            passages += 1
            whole = latest(conv, turn, " ".join(lines))
            for line in lines:
                n += 1
                first = latest(conv, turn, line) if whole is None else whole
                if first is not None:
                    linked += 1
                    near, all_of = weights.get(first, (0, 0))
                    weights[first] = (near + (at == 1), all_of + 1)
        reply = max(weights, key=lambda t: (*weights[t], t), default=None)
        out.append([passages, linked, n - linked, reply])
    parent = {}
    for (conv, turn, _), row in zip(messages, out):
        if turn is not None and row[3] is not None:
            parent[conv, turn] = max(row[3], parent.get((conv, turn), -1))
    for (conv, turn, _), row in zip(messages, out):
        root, depth = (turn, 0) if row[3] is None else (row[3], 1)
        while depth and (conv, root) in parent:
            root, depth = parent[conv, root], depth + 1
        row += [root, depth]
    return [tuple(r) for r in out]


def added(spark, messages, **more):
    df = spark.createDataFrame([(i, *m) for i, m in enumerate(messages)], "n long, conv_id long, turn long, text string").repartition(4)
    rows = {r["n"]: r for r in quotes.link_quotes(df).collect()}
    return [tuple(rows[i][c] for c in quotes.RESULTS) for i in range(len(messages))], [rows[i]["text"] for i in range(len(messages))]


def test_random_conversations(spark, monkeypatch):
    monkeypatch.setattr(quotes, "TURNS", 3)
    rng = random.Random(1)
    vocabulary = ["Thanks", "the quick brown", "fox jumps over", "yes, I agree", "no", "see below  for more"]
    messages = []
    for conv in (1, 2, None):
        texts = []
        for turn in range(25):
            lines = []
            for _ in range(rng.randint(0, 3)):
                if texts and rng.random() < 0.7:
                    old = rng.choice(texts).split("\n")
                    old = old if rng.random() < 0.7 else " ".join(old).split(" , ")
                    lines += [rng.choice(["> ", ">", " > ", ">> "]) + x.upper() if rng.random() < 0.3 else "> " + x for x in old] + [""]
            lines += rng.choices(vocabulary, k=rng.randint(0, 3))
            texts.append("\n".join(lines))
            at = None if rng.random() < 0.08 else turn - (rng.random() < 0.1)
            messages += [(conv, at, texts[-1])] * (2 if rng.random() < 0.1 else 1)
    got, _ = added(spark, messages)
    assert got == plain(messages)
    assert sum(r[3] is not None for r in got) > 20 and max(r[5] for r in got) > 2


def test_passages_wrapped_anew_and_the_latest_who_said_it(spark):
    messages = [
        (1, 0, "The quick brown fox jumps over the dog"),
        (1, 1, "Thanks"),
        (1, 2, "> the quick brown\n> fox jumps over the dog\nTrue."),
        (1, 3, "Thanks"),
        (1, 4, "> Thanks\nFor what?"),
        (1, 5, ">> the quick brown fox\n>> jumps over the dog\n> True.\nIndeed."),
        (1, None, "no quote B"),
        (1, None, "> For what?\nno turn"),
        (1, 6, None),
    ]
    got, texts = added(spark, messages)
    assert got == plain(messages)
    assert [r[3] for r in got] == [None, None, 0, None, 3, 2, None, 4, None]
    assert got[5][4:] == (0, 2) and got[7][4:] == (3, 2)
    assert texts[5] == "Indeed." and texts[8] == ""


def test_one_line_that_all_say(spark, monkeypatch):
    monkeypatch.setattr(quotes, "TURNS", 16)
    messages = [(1, i, "ok") if i % 2 == 0 else (1, i, "> ok\nok") for i in range(200)]
    got, _ = added(spark, messages)
    assert all(r[3] == i - 1 for i, r in enumerate(got) if i % 2) and got == plain(messages)


def test_order_of_replies(spark):
    messages = [(1, 0, "a"), (1, 1, "b"), (1, 2, "> a\nc"), (1, 3, "> b\nd"), (1, 4, "> c\ne"), (2, 0, "x")]
    df = spark.createDataFrame(messages, "conv_id long, turn long, text string")
    ordered = quotes.in_reply_order(quotes.link_quotes(df)).collect()
    assert [(r["conv_id"], r["turn"], r["text"]) for r in ordered] == [(1, 0, "a"), (1, 2, "c"), (1, 4, "e"), (1, 1, "b"), (1, 3, "d"), (2, 0, "x")]
    with pytest.raises(ValueError):
        quotes.link_quotes(df.withColumnRenamed("text", "root"))
    assert quotes.link_quotes(df.limit(0)).count() == 0
