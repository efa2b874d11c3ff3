"""The public functions in one place."""

from tissueloom.functions.columns import (  # noqa: F401
    count_byte,
    draw_key,
    filled_gene,
    gene_file_key,
    slice_z,
)
from tissueloom.operators.align import (  # noqa: F401
    apply_transform,
    check_pairing,
    compose_along,
    register_slices,
    rigid_fit,
    spatial_sample,
)
from tissueloom.operators.annotate import (  # noqa: F401
    annotate,
    annotate_cells,
    best_annotation,
    enrich,
    gene_to_tissue,
)
from tissueloom.operators.communities import communities, modularity  # noqa: F401
from tissueloom.operators.descent import descent_graph, descent_recall  # noqa: F401
from tissueloom.operators.grid import grid_knn  # noqa: F401
from tissueloom.operators.leiden import refined_communities  # noqa: F401
from tissueloom.operators.lineage import (  # noqa: F401
    assay_subset,
    attach_embedding,
    check_alignment,
    lineage_ancestor,
    lineage_edges,
    lineage_median,
    lineage_paths,
    lineage_transitions,
    pair_samples,
    lineage_wide,
    pair_prospects,
    stratified_sample,
    time_pairs,
)
from tissueloom.operators.local import local_foreground, segment_cells_locally, sharpen  # noqa: F401
from tissueloom.operators.longpca import by_number, fit_pca_long, numbered_cells  # noqa: F401
from tissueloom.operators.markers import (  # noqa: F401
    bh_adjust,
    cluster_and_rank,
    group_corr,
    group_sums,
    heatmap_table,
    marker_set,
    rank_markers,
    welch_table,
)
from tissueloom.operators.names import (  # noqa: F401
    file_batch,
    file_catalog,
    parse_slice_name,
    prefix_lookup,
)
from tissueloom.operators.neighbors import knn_graph, knn_join, symmetric_edges  # noqa: F401
from tissueloom.operators.outline import crop_to_outline, inside_outline  # noqa: F401
from tissueloom.operators.normalize import (  # noqa: F401
    check_batches,
    dense_counts,
    integrate,
    map_counts,
    pearson_resid,
)
from tissueloom.operators.pixels import (  # noqa: F401
    expand_labels,
    foreground,
    label_components,
    otsu_cuts,
    segment_cells,
    tile_cdf,
)
from tissueloom.operators.qc import (  # noqa: F401
    basic_stats,
    center_distance,
    nan_check,
    qc_box,
    qc_cells,
    qc_filter,
    qc_genes,
    qc_summary,
)
from tissueloom.operators.ranking import draw_threshold, exact_quantiles  # noqa: F401
from tissueloom.operators.reduce import fit_pca, n_components  # noqa: F401
from tissueloom.operators.soft import register_softly, scale_pairs, soft_steps  # noqa: F401
from tissueloom.operators.spots import (  # noqa: F401
    add_z,
    bin_spots,
    cell_props,
    cellbin_counts,
    count_image,
    count_image_byte,
    count_image_dense,
    crop_spots,
    fill_gene,
    gene_keys,
    label_long,
    param_join,
    prepare_spots,
    rebase_spots,
    slice_index,
    slice_origin,
)
from tissueloom.operators.touching import pixel_depths, split_touching  # noqa: F401
from tissueloom.sources.storage import drop_scratch, materialise  # noqa: F401
from tissueloom.sources.tables import (  # noqa: F401
    edge_scan,
    list_files,
    scan_cells,
    scan_gene_map,
    scan_matrix,
    scan_params,
    scan_spots,
    scan_tissue_map,
    write_by,
    write_csv,
    write_edges,
    write_image,
    write_labels,
    scan_lineage,
    write_lineage,
    write_matrix,
    write_spots,
)
