"""Dataset definitions of the layers, the dashboard views and the gated run."""
