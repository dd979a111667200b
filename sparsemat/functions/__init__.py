"""Column expressions on sparse vectors."""

from .vector import (
    vec_axpy,
    vec_drop_zeros,
    vec_from_dense,
    vec_nnz,
    vec_scale,
    vec_text,
    vec_to_dense,
    sparse_dot,
)

__all__ = [
    "sparse_dot",
    "vec_axpy",
    "vec_drop_zeros",
    "vec_from_dense",
    "vec_nnz",
    "vec_scale",
    "vec_text",
    "vec_to_dense",
]
