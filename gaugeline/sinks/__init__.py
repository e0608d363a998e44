"""Writers. Every one writes from the executors; nothing is collected."""
