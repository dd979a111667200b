"""Layout conversions and matrix products."""

from .estimate import auto_matmul, plan_product, product_size
from .layout import (
    cogroup_outer,
    from_blocks,
    from_row_vectors,
    nnz,
    replicate,
    scaled_rows,
    segment_pairs,
    sorted_by,
    split_halves,
    tag_union,
    to_blocks,
    to_column_vectors,
    to_row_vectors,
    transpose,
)
from .multiply import (
    masked_matmul,
    matmul,
    merge_partials,
    outer_matmul,
    partial_products,
    row_matmul,
    scaled_matmul,
    segmented_matmul,
    vector_sum,
)
from .skew import skew_join
from .stored import delta_products, store_factors, stored_matmul, update_partials
from .tiles import block_matmul, choose_grid, grid_matmul, to_tiles

__all__ = [
    "auto_matmul",
    "block_matmul",
    "choose_grid",
    "cogroup_outer",
    "delta_products",
    "from_blocks",
    "from_row_vectors",
    "grid_matmul",
    "masked_matmul",
    "matmul",
    "merge_partials",
    "nnz",
    "outer_matmul",
    "partial_products",
    "plan_product",
    "product_size",
    "replicate",
    "row_matmul",
    "scaled_matmul",
    "scaled_rows",
    "segment_pairs",
    "segmented_matmul",
    "skew_join",
    "sorted_by",
    "split_halves",
    "store_factors",
    "stored_matmul",
    "tag_union",
    "to_blocks",
    "to_column_vectors",
    "to_row_vectors",
    "to_tiles",
    "transpose",
    "update_partials",
    "vector_sum",
]
