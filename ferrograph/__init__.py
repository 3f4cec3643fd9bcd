"""Spark-native analytics over typed knowledge graphs and the text they are built from."""

from .operators.graph import Budgets, Graph, GraphError, build_graph, read_graph, validated, write_graph
from .operators.query import ValueNotFound, query_class, query_keyword
from .operators.records import Limits
from .sources.admit import Dataset, IngestError, load_dataset
from .sources.publish import write_dataset

__all__ = [
    "Budgets", "Dataset", "Graph", "GraphError", "IngestError", "Limits", "ValueNotFound", "build_graph", "load_dataset", "query_class", "query_keyword", "read_graph", "validated",
    "write_dataset", "write_graph",
]
