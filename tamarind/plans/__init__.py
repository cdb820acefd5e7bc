"""Reports: each function takes the frames it needs and returns the frame a user asked for."""
