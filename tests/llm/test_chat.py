import random

from pyspark.sql import functions as F

from starloom.llm.chat import HISTORY_TOKENS, PITCH, SYSTEM_TOKENS, escape, format_conversations, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string, run string, at string, member string, window string"


def rows():
    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice(["</s>", "[INST]", "a", "\\1", "\\", "<s>", "né"]) for _ in range(n))
    out = [(1, 0, "system", "be kind")] + [(1, t, ["user", "assistant"][t % 2], words(rng.randrange(90))) for t in range(1, 60)]
    out += [(2, t, ["assistant", "user"][t % 2], words(20)) for t in range(3000)]
    out += [(3, 0, "user", None), (3, None, "assistant", "late"), (3, 1, None, "no role"), (3, 1, "a\nb", "role\\7")]
    out += [(4, 0, "assistant", words(2000)), (4, 1, "assistant", "x"), (4, 1, "assistant", "x")]
    out += [(None, 0, "user", "stray"), (5, 0, "user", ""), (6, 5, "user", "q"), (6, 6, "system", "late rule"), (6, 7, "assistant", words(700))]
    return [(*r, *(["clash"] * 4)) for r in out]


def whole(read):
    """{conv: (turns, targets)} of read-back windows."""
    out = {}
    for r in sorted(read.collect(), key=lambda r: (r["run"], r["first"])):
        turns, targets = out.setdefault(r["conv_id"], ([], []))
        turns += [(t["role"], t["text"]) for t in r["turns"]]
        targets += r["targets"]
    return out


def test_round_trip_targets_and_budgets(spark):
    data = rows()
    windows = format_conversations(spark.createDataFrame(data, SCHEMA).repartition(4))
    got = whole(read_back(windows))
    expected = {}
    order = lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, _, role, text, *_ in sorted(data, key=order):
        turns, targets = expected.setdefault(conv, ([], []))
        turns.append((role or "", text or ""))
        if role == "assistant":
            targets.append(text or "")
    assert got == expected
    for w in windows.collect():
        turns = w["text"].count("<s>") if w["conv_id"] == 2 else None
        if w["conv_id"] == 2:
            assert turns and w["n_tokens"] <= 2 * PITCH + HISTORY_TOKENS
        if w["conv_id"] == 1 and w["first"] > 1:
            assert w["text"].startswith("<s>system\nbe kind</s>") and w["n_context"] >= 1
    assert windows.where("n_context > 1").count() > 0
    assert windows.where("conv_id = 2").select("run").distinct().count() == 3


def test_escape_is_reversible(spark):
    texts = ["", "\\", "\\1", "</s>", "<<SYS>>x<</SYS>>", "\\\\0</</s>s>", "[INST][/INST]\\</s>", "<\\s>"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert row["u"] == row["t"] and not any(c in row["e"] for c in ["</s>", "<s>", "[INST]", "[/INST]"])


def test_empty_table(spark):
    assert format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_windows(sizes, pitch, history_turns, history_tokens):
    """(numbers of the history turns, numbers of the new turns) of each window, by a plain loop over the whole conversation."""
    windows, before, longs = {}, 0, 0
    for at, size in enumerate(sizes):
        longs += size > pitch
        windows.setdefault((longs, size > pitch, before // pitch), []).append(at)
        before += size
    out = []
    for new in windows.values():
        back = [i for i in range(max(0, new[0] - history_turns), new[0]) if sum(sizes[i: new[0]]) <= history_tokens]
        out.append((back, new))
    return sorted(out, key=lambda w: w[1])


def test_windows_and_history_go_on_across_runs(spark):
    rng = random.Random(8)
    sizes = {1: [5 + rng.randrange(60) for _ in range(2100)], 2: [20] * 2100, 3: [4 + rng.choice([3, 10, 500]) for _ in range(700)]}
    gaps = {1: 1, 2: 1, 3: 700}  # in conversation 3 a run has one or two turns
    data = [
        (conv, i * gaps[conv], "user", " ".join([f"{i}"] + ["w"] * (size - 5)))
        for conv, all_sizes in sizes.items() for i, size in enumerate(all_sizes)
    ]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(5)
    got = {}
    for w in format_conversations(frame, history_turns=3).orderBy("conv_id", "first").collect():
        numbers = [int(p.split("\n", 1)[1].split(" ")[0]) for p in w["text"].split("</s>")[:-1]]
        assert w["first"] == numbers[w["n_context"]] + 1
        got.setdefault(w["conv_id"], []).append((numbers[: w["n_context"]], numbers[w["n_context"]:]))
    for conv, all_sizes in sizes.items():
        assert got[conv] == plain_windows(all_sizes, PITCH, 3, HISTORY_TOKENS)
    assert all(back for back, _ in got[2][1:])
    none = format_conversations(frame, history_turns=0)
    assert none.where("n_context > 0").count() == 0


def test_a_long_system_turn_stays_within_the_budget(spark):
    rules = " ".join(f"rule{i}" for i in range(5000))
    data = [(1, 0, "system", rules)] + [(1, t, ["assistant", "user"][t % 2], "w " * 60) for t in range(1, 90)]
    windows = format_conversations(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).orderBy("first").collect()
    assert windows[0]["n_context"] == 0 and windows[0]["text"] == f"<s>system\n{rules}</s>"
    assert len(windows) > 10
    for w in windows[1:]:
        assert w["text"].startswith("<s>system\nrule0 rule1 ") and "rule123 </s>" in w["text"] and "rule124" not in w["text"]
        assert w["n_tokens"] <= 2 * PITCH + HISTORY_TOKENS + SYSTEM_TOKENS
