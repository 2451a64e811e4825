"""The entry module works without the document operators."""
import sys

import __spark_entry__ as E
from clickwell.plans.registry import QUERIES, load_all


def test_queries_without_what_the_document_operators_need(monkeypatch):
    load_all()
    for hidden in ("clickwell.llm", "corpus_pipeline", "xxhash"):
        with monkeypatch.context() as m:
            for name in [n for n in sys.modules if n.split(".")[0] in ("corpus_pipeline", "xxhash") or n.startswith("clickwell.llm")]:
                m.delitem(sys.modules, name)
            m.setitem(sys.modules, hidden, None)   # importing it fails
            assert set(E.queries()) == set(QUERIES)
            assert set(E.oracle_sql()) <= set(QUERIES)
