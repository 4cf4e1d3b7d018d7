import random

from loomspan.operators import text


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_closest_words_up_to_three_edits_from_any_letter(spark):
    draw = random.Random(2)
    known = {"company": 500, "the": 900, "forecast": 300, "international": 200, "forest": 300, "price": 400}
    rare = {"kompany": 1, "hte": 5, "xompani": 2, "orecasts": 1, "tnternationalen": 1, "zzzzzzzzzz": 1}
    for w in list(known):
        for _ in range(15):
            t = list(w)
            for _ in range(draw.randrange(1, 5)):
                i = draw.randrange(len(t) + 1)
                t[i : i + draw.randrange(2)] = draw.choice(["", "a", "x"])
            rare.setdefault("".join(t), 1)
    rare = {w: n for w, n in rare.items() if w not in known and w}
    df = spark.createDataFrame([*known.items(), *rare.items()], "word string, n bigint")
    got = {r.word: (r.known, r.edits) for r in text.closest_words(df, "word", "n", 0.05).collect()}
    want = {}
    for w in rare:
        e, _, k = min((edits(w, k), -n, k) for k, n in known.items())
        if e <= 3:
            want[w] = (k, e)
    assert got == want
    assert got["kompany"] == ("company", 1) and got["xompani"] == ("company", 2) and "zzzzzzzzzz" not in got
