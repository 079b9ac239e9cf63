"""Renderings against a plain loop."""

from clausewise.llm import chat


def plain(rows):
    convs, out = {}, []
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "unknown", text or ""))
    for conv, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        for me in {r for _, r, _ in turns if r != "system"}:
            at, pieces, learn = 0, [], []
            for _, role, text in turns:
                first = "<|assistant|>\n" if role == me else "<|system|>\n" if role == "system" else f"<|user name={role}|>\n"
                piece = first + text + "<|end|>\n"
                if role == me:
                    learn.append((at + len(first), at + len(piece) - 1))
                at += len(piece)
                pieces.append(piece)
            out.append((conv, me, "".join(pieces), learn))
    return sorted(out, key=str)


def test_renderings(spark):
    rows = [(1, i, ["ann", "bob", "cy"][i % 3], f"wörd {i}") for i in range(400)]
    rows += [(2, 0, "system", "be kind"), (2, 1, "user", None), (2, 1, "user", None), (2, None, None, "😀"), (3, 0, "system", "alone")]
    rows += [(None, 5, "user", "no id"), (None, 4, "assistant", ""), (4, 7, "user", "x" * 30000), (4, 7, "user", "a")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, piece int")
    pieces = chat.perspectives(turns)
    got = [(r.conv_id, r.perspective, r.text, [tuple(x) for x in r.learn]) for r in chat.render(pieces).collect()]
    assert sorted(got, key=str) == plain(rows)
    assert chat.perspectives(turns.limit(0)).count() == 0
    for r in pieces.collect():
        assert r.end - r.start == len(r.piece) and r.start <= r.learn_start <= r.learn_end <= r.end
