"""Extract files in, warehouse tables out."""
