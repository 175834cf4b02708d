import collections
import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from webcorpus.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>\n", "\\", "<\\s>", "<<SYS>>", "a\\\\<s>", "", None, "é😀", C.PROBE, "<|im_start|>user\nhi<|im_end|>\n"]


def digests(rows):
    out = {}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        learned = "".join(x for *_, role, x in turns if role == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in turns).encode()).hexdigest(),
                  len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def rows(seed=6):
    r = random.Random(seed)
    out = [(c, t, r.choice(["user", "assistant", "system", None]), "".join(x or "" for x in r.choices(NASTY, k=r.randint(0, 4))) if r.random() < .9 else None)
           for c in range(40) for t in range(r.randint(1, 9))]
    out += [(50, t, "assistant" if t % 2 else "user", f"turn {t} " + r.choice(NASTY[:5])) for t in range(700)]
    out += [(51, 0, "user", "same"), (51, 0, "user", "same"), (None, 1, "assistant", "x"), (None, None, "user", "y")]
    r.shuffle(out)
    return out


def test_round_trip_of_all_texts_roles_and_masks(frame):
    data = rows()
    got = C.read_back(C.format_turns(frame(data, SCHEMA))).collect()
    expected = digests(data)
    assert len(got) == len(expected)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected


def test_turns_join_to_the_template_s_rendering_of_the_whole(frame):
    data = [x for x in rows() if x[0] is not None and x[0] != 51 and x[1] is not None]
    got = collections.defaultdict(list)
    for r in C.format_turns(frame(data, SCHEMA)).collect():
        got[r.conv_id].append((r.place, r.formatted, r.rewrites))
    for c, parts in got.items():
        turns = sorted((t, role or "", text or "") for conv, t, role, text in data if conv == c)
        assert "".join(f for _, f, _ in sorted(parts)) == C.template([{"role": r, "text": x} for _, r, x in turns])
        assert not any(w for *_, w in parts)


def test_detects_templates_that_rewrite_history(frame):
    def last_marked(turns):  # an end mark after the last turn only
        return "".join(f"[{t['role']}]{t['text']};" for t in turns) + "<end>"

    def without_old_thoughts(turns):  # drops a part of every turn but the last
        return "".join(f"{t['role']}: {t['text'] if i == len(turns) - 1 else t['text'].split('|')[-1]}\n" for i, t in enumerate(turns))

    data = frame([(1, 0, "user", "hi"), (1, 1, "assistant", "think|yes"), (1, 2, "user", "more")], SCHEMA)
    for render, marks in ((C.template, [False] * 3), (last_marked, [True] * 3), (without_old_thoughts, [False, False, True])):
        got = sorted(C.format_turns(data, render=render).collect(), key=lambda r: r.place)
        assert [r.rewrites for r in got] == marks, render


def test_templates_that_look_far_back(frame):
    def say(turns):
        return "".join(f"{t['role']}: {t['text']}\n" for t in turns)

    def first_answer_rewritten(turns):  # turn 1 is dropped from turn 8 on
        return say([t for i, t in enumerate(turns) if i != 1 or len(turns) < 9])

    def last_five(turns):
        return say(turns[-5:])

    def user_first(turns):
        assert not turns or turns[0]["role"] == "user"
        return say(turns)

    data = frame([(1, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(10)], SCHEMA)
    for render, marked in ((first_answer_rewritten, [8]), (last_five, [5, 6, 7, 8, 9]), (user_first, [])):
        got = sorted(C.format_turns(data, render=render).collect(), key=lambda r: r.place)
        assert [r.place for r in got if r.rewrites] == marked, render
    assert not any(r.rewrites for r in C.format_turns(data, render=say, context=0).collect())


def test_mask_of_another_template(frame):
    def render(turns):
        return "".join(f"### {t['role']}:\n{t['text']}\n\n" for t in turns)

    data = [(1, 0, "user", "q"), (1, 1, "assistant", "\n\n### user:\nx\n"), (1, 2, "assistant", "\n")]
    got = sorted(C.format_turns(frame(data, SCHEMA), render=render).collect(), key=lambda r: r.place)
    assert [None if r.loss_start is None else r.formatted[r.loss_start:r.loss_end] for r in got] == [None, data[1][3], "\n"]


def test_empty_table_and_clashing_columns(frame):
    df = frame([(1, 0, "assistant", "hi", "z")], "conv_id long, turn long, role string, text string, formatted string")
    assert C.read_back(C.format_turns(df)).collect()[0].loss_chars == 2
    assert C.read_back(C.format_turns(df.limit(0))).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*C.CONTROL, "\\", "<", ">", "s", "[", "|", "n", "\n", "é"]), max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = C.escape(text)
    assert C.unescape(escaped) == text and not any(c in escaped for c in C.CONTROL)
    assert C.parse(C.template([{"role": text, "text": text}] * 2)) == [(text, text)] * 2
