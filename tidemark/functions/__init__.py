"""Column expressions: numbers, names and links. All are built-in Spark functions."""

from tidemark.functions.html import decode_entities, link_array
from tidemark.functions.names import dataset_name, dataset_of_file, with_suffix
from tidemark.functions.numbers import as_measure
from tidemark.functions.tokens import word_array

__all__ = [
    "as_measure",
    "dataset_name",
    "dataset_of_file",
    "decode_entities",
    "link_array",
    "word_array",
    "with_suffix",
]
