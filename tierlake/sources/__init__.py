"""Reading raw JSON and keeping the warehouse tables."""
