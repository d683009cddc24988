"""Writers: layer tables, JSON folders, versions, manifests."""
