"""Writers: manifests, rasters, text exports."""
