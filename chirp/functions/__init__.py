"""Column-expression builders: every function returns a pyspark Column
that stays inside whole-stage codegen (no Python UDFs)."""

from chirp.functions.text import (clean_text, first_mention, flatten_newlines,
                                  hashtag_field, media_field, py_str)
from chirp.functions.timeparts import created_at_parts, strip_offset
from chirp.functions.buckets import polarity_label, subjectivity_label

__all__ = ["clean_text", "first_mention", "flatten_newlines", "hashtag_field",
           "media_field", "py_str", "created_at_parts", "strip_offset",
           "polarity_label", "subjectivity_label"]
