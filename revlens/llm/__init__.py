"""Training-data operators: near-duplicate detection, extraction,
fingerprints, packing, personal data, tokenisation, archives, toxicity.

Nothing outside this subpackage imports it; its queries are registered by
`revlens.llm.queries` and added by ``__spark_entry__`` when it is present.
"""
