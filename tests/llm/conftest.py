import pytest

pytest.importorskip("holdfast.llm")
