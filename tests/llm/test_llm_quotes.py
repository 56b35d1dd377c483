"""Quotation linking on small conversations and against a plain search."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tidemark.llm import quotes


@pytest.fixture
def messages(spark):
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, hash string")


def linked(df):
    return [tuple(r) for r in quotes.linked_conversations(df).collect()]


def test_nested_quotes_build_the_thread(messages):
    rows = [
        (1, 0, "user", "How do I  sort a list?"),
        (1, 1, "assistant", "> how do i sort a list?\nUse sorted()."),
        (1, 2, "user", "Unrelated."),
        (1, 3, "user", "Ann wrote:\n> > How do I sort a list?\n> Use sorted().\nThat works, thanks."),
        (1, 4, "assistant", ">> Use sorted().\n> That works, thanks.\nYou are welcome."),
        (2, 0, "user", "> Use sorted().\nA quote from elsewhere."),
    ]
    got = {(r[0], r[3]): r for r in linked(messages(rows))}
    assert got[1, 0][1:3] == (0, 0) and got[1, 1][1:3] == (0, 1) and got[1, 3][1:3] == (0, 2) and got[1, 4][1:3] == (0, 3)
    assert got[1, 2][1:3] == (2, 0) and got[2, 0][1:3] == (0, 0)
    assert [got[1, t][5] for t in range(5)] == [None, 0, None, 1, 3]
    assert got[1, 3][6:] == (2, 2, "That works, thanks.", []) and got[2, 0][6:] == (1, 0, "A quote from elsewhere.", ["Use sorted()."])
    assert [r[3] for r in linked(messages(rows)) if r[0] == 1] == [0, 1, 3, 4, 2]


def test_single_lines_of_a_message_can_be_quoted(messages):
    rows = [(1, 0, "a", "first line\nsecond line\n\na paragraph"), (1, 1, "b", "> second line\nyes"), (1, 2, "c", "> second line\n> something else\nno")]
    got = linked(messages(rows))
    assert [(r[3], r[5]) for r in got] == [(0, None), (1, 0), (2, 0)]


def test_sentences_and_rewrapped_paragraphs(messages):
    rows = [
        (1, 0, "a", "One thing is this. Another thing is that! A third?\nno end here\n\nA second paragraph that\nruns over lines. It ends."),
        (1, 1, "b", "Nothing of this."),
        (1, 2, "c", "> another thing\n> is that!\nYes."),
        (1, 3, "d", "> A second paragraph\n> that runs over\n> lines. It ends.\n>\n> unknown words\nRight."),
        (1, 4, "e", "> unknown words\n> One thing is this.\nHm.\n>>> doctest()"),
    ]
    got = {r[3]: r for r in linked(messages(rows))}
    assert [got[t][5] for t in range(5)] == [None, None, 0, 0, 0]
    assert got[4][6:] == (2, 1, "Hm.", ["doctest()"])


def plain_pieces(text):
    out = [(0, text)] + [(1, p) for p in re.split(r"\n\s*\n", text)]
    out += [(2, line) for line in text.split("\n")]
    out += [(2, s) for p in re.split(r"\n\s*\n", text) for s in re.split(r"(?<=[.!?]) +", " ".join(p.split()))]
    return {(kind, " ".join(p.lower().split())) for kind, p in out if p.strip()}


def plain_parents(own, quoted):
    """The turn each message answers: search every earlier message for every piece of the first-level quotes."""
    parents = {}
    for turn, passages in quoted.items():
        score = Counter()
        for passage in passages:
            for kind in range(3):
                found = []
                for piece in {p for k, p in plain_pieces(passage) if k == kind}:
                    holding = [t for t in own if t < turn and piece in {p for _, p in plain_pieces(own[t])}]
                    found += [(max(holding), len(piece))] if holding else []
                if found:
                    for source, chars in found:
                        score[source] += chars
                    break
        parents[turn] = max(score, key=lambda t: (score[t], t)) if score else None
    return parents


@pytest.mark.parametrize("seed", range(3))
def test_random_nested_threads(messages, seed):
    """Messages that quote others whole, by paragraph, line or sentence, two levels deep, with noise between."""
    chance = random.Random(seed)
    own, quoted, rows = {}, {}, []
    for turn in range(40):
        own[turn] = "\n\n".join(
            "\n".join(" ".join(f"W{chance.randrange(60)} x{chance.randrange(60)}{chance.choice('.!?')}" for _ in range(2)) for _ in range(chance.randint(1, 2)))
            for _ in range(chance.randint(1, 2))
        )
        lines, quoted[turn] = [], []
        for part in range(chance.randint(0, 2) if turn else 0):
            from_ = own[chance.randrange(turn)]
            pieces = [from_, chance.choice(re.split(r"\n\n", from_)), chance.choice([x for x in from_.split("\n") if x]), f"noise {turn} {part}"]
            piece = chance.choice(pieces)
            quoted[turn].append(piece)
            lines += [f"> {line}" for line in piece.split("\n")]
            lines += [f">> {own[chance.randrange(turn)].split(chr(10))[0]}"] if chance.random() < 0.3 else []
            lines.append(f"between {turn} {part}")
        own[turn] = "\n".join([*(line for line in lines if not line.startswith(">")), own[turn]])
        rows.append((seed, turn, "u", "\n".join([*lines, own[turn].split("\n", sum(not line.startswith(">") for line in lines))[-1]])))
    wanted = plain_parents(own, quoted)
    got = {r[3]: r for r in linked(messages(rows))}
    assert {t: r[5] for t, r in got.items()} == wanted and any(p is not None for p in wanted.values())
    for turn, r in got.items():
        up, depth = turn, 0
        while wanted[up] is not None:
            up, depth = wanted[up], depth + 1
        assert (r[1], r[2]) == (up, depth)


def test_the_latest_earlier_original_counts_in_blocks_too(messages, monkeypatch):
    monkeypatch.setattr(quotes, "BLOCK_TURNS", 4)
    chance = random.Random(1)
    rows = [(1, t, "u", chance.choice(["ok", f"> ok\nanswer {t}", f"> OK \nok", "other"])) for t in range(120)]
    own = {t: quotes.parse(text)[0] for _, t, _, text in rows}
    for r in linked(messages(rows)):
        text = rows[r[3]][3]
        before = [t for t in range(r[3]) if "ok" in own[t].split("\n")]
        assert r[5] == (before[-1] if text.startswith(">") and before else None)


def test_long_chains(messages):
    rows = [(1, 0, "u", "message 0")] + [(1, t, "u", f"> message {t - 1}\nmessage {t}") for t in range(1, 70)]
    assert [(r[1], r[2], r[3]) for r in linked(messages(rows))] == [(0, t, t) for t in range(70)]


def test_edges(messages):
    rows = [(None, 0, "u", "a"), (1, None, "u", "> a\nb"), (1, 0, None, None), (1, 1, "u", ""), (1, 2, "u", ">"), (1, 3, "u", "> \n>\n\n"), (1, 4, "u", "x " * 50_000)]
    rows += [(1, 5, "u", "twice"), (1, 5, "u", "twice"), (1, 6, "u", "> twice\n"), (1, 6, "u", "> twice\n")]
    got = linked(messages(rows))
    assert len(got) == len(rows)
    by_turn = {(r[0], r[3]): r for r in got}
    assert by_turn[1, 0][8] is None and by_turn[1, 1][8] == "" and by_turn[1, 2][8] == "" and by_turn[1, 6][5] == 5 and by_turn[1, 6][8] == ""
    assert by_turn[1, 4][8] == "x " * 50_000
    assert linked(messages([])) == []
