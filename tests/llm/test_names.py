"""Keys of names of many spellings."""

import pandas as pd

from fieldreel.llm import names

WORDS = [f"word{c}" for c in "abcdefgh"]
# two spellings for each of eight words, and one word of three, of which the likeliest is not the one shared: 768 spellings
SPELT = {w: [f"{w}x", w] for w in WORDS} | {"pine": ["pint", "pink", "pine"]}


def test_names_of_many_spellings_share_those_in_the_middle():
    a = set(names.name_keys("||", "lake", sorted([*WORDS, "pine"]), SPELT, {}))
    b = set(names.name_keys("||", "lake", sorted([*(f"{w}x" for w in WORDS[:4]), *WORDS[4:], "pink"]), SPELT, {}))
    assert len({k for k, initial in a if not initial}) == 3 * 2**8
    assert {k for k, initial in b if not initial} <= {k for k, initial in a if not initial}
    assert any(initial for _, initial in a & b)


def test_keys_leave_a_task_in_parts(monkeypatch):
    monkeypatch.setattr(names, "KEYS_AT_ONCE", 100, raising=False)
    found = [{"text": t, "word": True, "reps": r} for t, r in SPELT.items()]
    batch = pd.DataFrame({"node": [1, 2], "fixed": ["||"] * 2, "kind": ["lake"] * 2, "words": [" ".join(sorted([*WORDS, "pine"])), "solo pink"], "found": [found, None]})
    parts = list(names._keys(iter([batch])))
    keys = {(k, i, n) for p in parts for k, i, n in zip(p["key"], p["initial"], p["node"], strict=True)}
    assert len(parts) > 5 and all(len(p) <= 100 for p in parts)
    assert keys == {(names._signed(k), i, 1) for k, i in names.name_keys("||", "lake", sorted([*WORDS, "pine"]), SPELT, {})} | {(names._signed(k), i, 2) for k, i in names.name_keys("||", "lake", ["solo", "pink"], {}, {})}
