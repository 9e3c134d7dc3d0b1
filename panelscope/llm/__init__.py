"""Training-data operators: filtering, extraction, deduplication, PII, tokenization, mixing, scoring.

Nothing outside this subpackage imports it. Each module holds one operator with a general
DataFrame interface; :mod:`panelscope.llm.queries` registers one ``opN_<name>`` query per operator.
"""
