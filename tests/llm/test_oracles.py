"""What ``ORACLES`` holds is SQL text."""

from harborline.llm.queries import ORACLES, QUERIES


def test_oracles_are_text():
    assert ORACLES and set(ORACLES) <= set(QUERIES)
    assert all(isinstance(sql, str) for sql in ORACLES.values())
