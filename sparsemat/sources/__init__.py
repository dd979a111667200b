"""Readers, writers and the matrix generator."""

from .generate import generate_pair, generate_sparse, sample_cells, sample_pair, sample_rows
from .readers import (
    LineCounts,
    MalformedLines,
    parse_coo,
    parse_outer_records,
    parse_row_vectors,
    parse_scaled_rows,
    read_coo,
    read_lines,
    read_outer_records,
    read_partials,
    read_row_vectors,
    read_scaled_rows,
)
from .writers import (
    format_coo,
    format_outer_records,
    format_row_vectors,
    format_scaled_rows,
    write_coo,
    write_outer_records,
    write_partials,
    write_row_vectors,
    write_scaled_rows,
)

__all__ = [
    "LineCounts",
    "MalformedLines",
    "format_coo",
    "format_outer_records",
    "format_row_vectors",
    "format_scaled_rows",
    "generate_pair",
    "generate_sparse",
    "parse_coo",
    "parse_outer_records",
    "parse_row_vectors",
    "parse_scaled_rows",
    "read_coo",
    "read_lines",
    "read_outer_records",
    "read_partials",
    "read_row_vectors",
    "read_scaled_rows",
    "sample_cells",
    "sample_pair",
    "sample_rows",
    "write_coo",
    "write_outer_records",
    "write_partials",
    "write_row_vectors",
    "write_scaled_rows",
]
