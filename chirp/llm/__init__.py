"""Training-data operators: near-duplicate removal, licence scan, chat
formatting, quality rules and classifier, packing, BPE, embeddings,
sharding and line dedup. Nothing outside this subpackage imports it."""
