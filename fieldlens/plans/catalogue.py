"""From a catalogue table and a file listing to the products an analysis can use."""

from fieldlens.operators.tables import add_band_paths, granule_filter, search_catalogue


def usable_products(products, product_files, box, start, end, **options):
    """Search, tile filter and band paths; one row per product."""
    return add_band_paths(granule_filter(search_catalogue(products, box, start, end, **options)), product_files)
