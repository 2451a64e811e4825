import random

from clickwell.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, h1 string"


def test_collapse_equals_brute_force(spark):
    rng = random.Random(0)
    stock = [[("user" if i % 2 == 0 else "assistant", rng.choice(["hi", "yes", "no", "<|im_end|>"])) for i in range(rng.randint(1, 6))] for _ in range(15)]
    logs = [c[:rng.randint(1, len(c))] for c in stock for _ in range(4)]
    rows = [(k, i, r, t, "x") for k, c in enumerate(logs) for i, (r, t) in enumerate(c)]
    rng.shuffle(rows)
    got = {r.conv_id: r for r in chat.maximal_conversations(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    want = {}
    for k, c in enumerate(logs):
        if not any(d[:len(c)] == c and (len(d) > len(c) or j < k) for j, d in enumerate(logs) if j != k):
            want[k] = (len(c), sum(d == c for d in logs))
    assert {k: (r.n_turns, r.n_logged) for k, r in got.items()} == want
    for k, r in got.items():
        assert r.rendered == "".join(f"<|im_start|>{a}\n{b.replace('<|', '<\\|')}<|im_end|>\n" for a, b in logs[k])


def test_defined_cases(spark):
    rows = [(1, 0, "user", "a", None), (1, 0, "user", "a", None), (1, 1, None, None, None), (2, None, "user", "z", None),
            (2, 0, "user", "y", None), (None, 0, "user", "a", None), (3, 0, "user", "a", None), (4, 0, "user", "a" * 100_000, None)]
    got = {r.conv_id: r.rendered for r in chat.maximal_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {1, 2, 4}  # 3 is a snapshot of 1
    assert got[1] == "<|im_start|>user\na<|im_end|>\n<|im_start|>unknown\n<|im_end|>\n"
    assert got[2].index("z") < got[2].index("y")
    assert chat.maximal_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_first_turn_is_combined_before_the_join(spark):
    rows = [(i, 0, "user", "hello", None) for i in range(200)] + [(i, 1, "assistant", f"answer {i}", None) for i in range(1, 200)]
    got = chat.maximal_conversations(spark.createDataFrame(rows, SCHEMA))
    assert got.count() == 199 and got.filter("conv_id = 0").count() == 0
