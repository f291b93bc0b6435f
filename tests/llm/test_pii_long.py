from __future__ import annotations

import random
import re

from headway.llm import pii


def test_long_secrets_are_found_to_their_end(spark):
    r = random.Random(3)
    run = lambda n, of: "".join(r.choice(of) for _ in range(n))
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    values = [run(n, of) for n in (128, 129, 200, 700, 5000) for of in ("abcdef0123456789", base64)]
    df = spark.createDataFrame([(i, f'so token = "{v}" leaked') for i, v in enumerate(values)], "n int, text string")
    got = [x["text"] for x in pii.redact(df).orderBy("n").collect()]
    assert [t for t in got if not re.fullmatch(r'so (\[(SECRET|CARD)\])+" leaked', t)] == []
