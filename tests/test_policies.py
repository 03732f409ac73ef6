"""Source-level guards for the scale rules the library follows."""

import pathlib
import re

LIB = pathlib.Path(__file__).resolve().parents[1] / "marquee"
# the text operators have policy tests of their own
SOURCES = {p: p.read_text() for p in LIB.rglob("*.py") if p.parent.name != "llm"}

# the only driver collects, each of a bounded, small result
ALLOWED_COLLECTS = {
    "operators/quality.py": "the quality report (a dozen rows)",
    "plans/job.py": "the id-check report (two rows)",
}


def _code(text: str) -> str:
    return "\n".join(ln.split("#", 1)[0] for ln in text.splitlines())


def test_no_local_checkpoint_broadcast_hint_rdd_or_python_udf():
    for path, text in SOURCES.items():
        code = _code(text)
        assert "localCheckpoint" not in code, path
        assert not re.search(r"\bbroadcast\(", code), path
        assert ".rdd" not in code and "mapPartitions" not in code, path
        assert not re.search(r"@udf|F\.udf\(|pandas_udf", code), path


def test_driver_collects_are_bounded():
    for path, text in SOURCES.items():
        rel = path.relative_to(LIB).as_posix()
        if "collect()" in _code(text):
            assert rel in ALLOWED_COLLECTS, f"unexpected collect() in {rel}"
