"""Models: staging, intermediate, marts, and the dashboard queries over them."""
