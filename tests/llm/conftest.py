from tests.llm.edges import edge_docs, no_docs  # noqa: F401
